"""Marts kept by what batches change, and state kept by streaming queries, against full rebuilds."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.changes import delete, fold_orders, frame, message, order_rows, upsert
from tests.test_state import random_messages
from tidemark.operators import state
from tidemark.plans import kept, marts
from tidemark.schemas import ENTITIES
from tidemark.sources.changes import file_stream
from tidemark.streaming import stateful
from tidemark.streaming import store as store_module
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.store import ChangeStore


def shown(mart):
    """Rows as text, so that NaN equals NaN."""
    return Counter(tuple(map(str, r)) for r in mart.select(sorted(mart.columns)).collect())


def check(store):
    for name in kept.MARTS:
        assert shown(store.kept_mart(name)) == shown(marts.MARTS[name](store.tables())), name


def random_changes(rng, count, start):
    """Orders and customers that come, change, move and go."""
    found = []
    for offset in range(start, start + count):
        if rng.random() < 0.3:
            key = rng.randrange(8)
            after = {"customer_id": key, "city": rng.choice(["a", "b", "c", None])}
            found.append(delete("customers", offset, key) if rng.random() < 0.3 else upsert("customers", offset, after))
        else:
            key = rng.randrange(25)
            after = {
                "order_id": key, "customer_id": rng.randrange(10), "status": rng.choice(["placed", "canceled", None]),
                "order_ts": rng.choice([None, f"2024-01-0{rng.randrange(1, 4)}T{rng.randrange(24):02d}:10:00"]),
                "total_amount": rng.choice([None, 0, 12.5, 99.99, 1e10, "NaN", "Infinity", "-Infinity", 3.005, -4.25]),
            }
            found.append(delete("orders", offset, key) if rng.random() < 0.25 else upsert("orders", offset, after))
    return found


def test_kept_marts_equal_a_rebuild_after_every_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "MOST_PARTS", 3)
    rng = random.Random(1)
    store = ChangeStore(spark, str(tmp_path / "store"), keep_marts=True)
    for number in range(4):
        store.apply_batch(frame(spark, random_changes(rng, 60 if number < 2 else 8, 100 * number)), number)
        check(store)
    others = [upsert("products", 900, {"product_id": 1}), message("orders", 901, "{bad")]
    store.apply_batch(frame(spark, others), 4)
    check(store)


def test_everything_gone_leaves_empty_marts(spark, tmp_path):
    store = ChangeStore(spark, str(tmp_path / "store"), keep_marts=True)
    order = {"order_id": 1, "customer_id": 1, "status": "placed", "total_amount": 3.335, "order_ts": "2024-01-01T00:00:00"}
    store.apply_batch(frame(spark, [upsert("orders", 0, order), upsert("customers", 1, {"customer_id": 1, "city": "a"})]), 0)
    check(store)
    store.apply_batch(frame(spark, [delete("orders", 2, 1)]), 1)
    assert all(store.kept_mart(name).count() == 0 for name in kept.MARTS)


def test_a_store_that_kept_no_marts_gets_them_later(spark, tmp_path):
    path, rng = str(tmp_path / "store"), random.Random(5)
    plain = ChangeStore(spark, path)
    plain.apply_batch(frame(spark, random_changes(rng, 50, 0)), 0)
    store = ChangeStore(spark, path, keep_marts=True)
    store.apply_batch(frame(spark, random_changes(rng, 10, 100)), 1)
    check(store)
    with pytest.raises(LookupError):
        store.kept_mart("top_products")


def test_a_small_batch_writes_its_groups_only(spark, tmp_path):
    store = ChangeStore(spark, str(tmp_path / "store"), keep_marts=True)
    many = [
        upsert("orders", i, {"order_id": i, "customer_id": i % 7, "status": "placed", "total_amount": 1.0, "order_ts": f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00:00"})
        for i in range(300)
    ]
    store.apply_batch(frame(spark, many), 0)
    store.apply_batch(frame(spark, [upsert("orders", 500, {"order_id": 5, "customer_id": 5, "status": "canceled", "total_amount": 1.0, "order_ts": "2024-01-01T05:00:00"})]), 1)
    parts = store.commit().parts
    assert parts[kept.HOURS][1] == ["1", 1] and parts[kept.CUSTOMERS][1] == ["1", 1]
    assert parts[kept.STATUSES] == [["1-whole", 2]]  # two rows outnumber the one that was there
    check(store)


def test_failed_batch_leaves_kept_marts_alone(spark, tmp_path, monkeypatch):
    store = ChangeStore(spark, str(tmp_path / "store"), keep_marts=True)
    rng = random.Random(9)
    store.apply_batch(frame(spark, random_changes(rng, 40, 0)), 0)
    before = {name: shown(store.kept_mart(name)) for name in kept.MARTS}
    batch = random_changes(rng, 20, 100)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(kept, "city_sums", lost)
    with pytest.raises(RuntimeError):
        store.apply_batch(frame(spark, batch), 1)
    assert {name: shown(store.kept_mart(name)) for name in kept.MARTS} == before
    monkeypatch.undo()
    store.apply_batch(frame(spark, batch), 1)
    check(store)


def land(spark, folder, messages):
    frame(spark, messages).coalesce(1).write.mode("append").parquet(str(folder))


def test_state_in_the_query_survives_a_restart(spark, tmp_path):
    """Keys of one partition in order; a message that comes late or twice changes nothing."""
    messages = random_messages(11, count=240)
    folder, written, checkpoint = tmp_path / "in", str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    orders = ENTITIES["orders"]

    def run():
        stateful.start_state(file_stream(spark, str(folder), files_per_batch=1), orders, written, checkpoint).awaitTermination()
        return order_rows(stateful.read_state(spark, orders, written))

    for start in range(0, 180, 60):
        land(spark, folder, messages[start : start + 60])
    assert run() == fold_orders(messages[:180])
    land(spark, folder, [messages[179], messages[0], *messages[180:]])
    assert run() == fold_orders(messages)
    written_rows = {r["rows"]: r["count"] for r in spark.read.parquet(written).groupBy("rows").count().collect()}
    assert len(written_rows) == 4 and max(written_rows.values()) <= 13  # each batch: the keys that it changed
    assert run() == fold_orders(messages)


def test_messages_pass_once_through_the_state(spark, tmp_path):
    messages = random_messages(12, count=90)
    folder, store = tmp_path / "in", ChangeStore(spark, str(tmp_path / "store"))
    land(spark, folder, messages[:40] + messages[10:20])
    land(spark, folder, messages[30:70])
    ingest_available(file_stream(spark, str(folder), files_per_batch=1), store, str(tmp_path / "checkpoint"))
    assert store.log().count() == 70
    land(spark, folder, messages[50:90] + messages[:5])
    ingest_available(file_stream(spark, str(folder), files_per_batch=1), store, str(tmp_path / "checkpoint"))
    assert store.log().count() == 90
    assert order_rows(store.current("orders")) == fold_orders(messages)


def test_positions_can_be_forgotten_after_a_delay(spark, tmp_path):
    messages = random_messages(13, count=30)
    land(spark, tmp_path / "in", messages + messages[:10])
    stream = file_stream(spark, str(tmp_path / "in")).withColumn("arrived", F.current_timestamp())
    once = stateful.each_message_once(stream, delay="1 hour", arrived="arrived").drop("arrived")
    query = once.writeStream.format("memory").queryName("once_only").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("once_only").count() == 30


def test_current_rows_is_one_aggregation(spark, tmp_path):
    land(spark, tmp_path / "in", random_messages(14, count=5))
    rows = stateful.current_rows(file_stream(spark, str(tmp_path / "in")), ENTITIES["orders"])
    assert rows.isStreaming and rows.columns == state.versioned_columns(ENTITIES["orders"])
    assert rows._jdf.queryExecution().analyzed().toString().count("Aggregate") == 1
