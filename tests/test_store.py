"""The stored log and tables: streaming, replays, failures, clean-up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.changes import delete, fold_orders, frame, message, order_rows, upsert
from tests.test_state import random_messages
from tidemark.sources.changes import file_stream, only_topics, topics
from tidemark.sources.tables import catalog_tables, missing_tables
from tidemark.streaming import store as store_module
from tidemark.streaming.ingest import ingest_available, start_ingest
from tidemark.streaming.store import ChangeStore


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def land(spark, folder, messages):
    """Append messages as one file of a file-based source."""
    frame(spark, messages).coalesce(1).write.mode("append").parquet(str(folder))


def test_empty_store(spark, root):
    store = ChangeStore(spark, root)
    assert store.current("orders").count() == 0
    assert store.current("orders").columns == ["order_id", "customer_id", "order_ts", "status", "total_amount"]
    assert store.log().count() == 0
    assert store.quarantine().count() == 0
    assert store.latest_events().count() == 0


def test_streamed_in_batches(spark, root, tmp_path):
    messages = random_messages(3, count=240)
    for start in range(0, 240, 80):
        land(spark, tmp_path / "in", messages[start : start + 80])
    store = ChangeStore(spark, root)
    source = file_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    ingest_available(source, store, f"{root}/checkpoint")
    assert order_rows(store.current("orders")) == fold_orders(messages)
    assert store.log().count() == 240
    assert store.commit().number == 2
    # A restart from the checkpoint has nothing to do; new files continue from there.
    more = random_messages(4, count=50, start=240)
    land(spark, tmp_path / "in", more)
    ingest_available(source, store, f"{root}/checkpoint")
    assert order_rows(store.current("orders")) == fold_orders(messages + more)
    assert (store.log().count(), store.commit().number) == (290, 3)
    # Another query over the same files, without the checkpoint: logged messages are left out.
    again = ChangeStore(spark, root)
    ingest_available(source, again, f"{root}/checkpoint-2")
    assert again.log().count() == 290
    assert order_rows(again.current("orders")) == fold_orders(messages + more)


def test_continuous_query_stops(spark, root, tmp_path):
    land(spark, tmp_path / "in", [upsert("orders", 0, {"order_id": 1, "customer_id": 1})])
    store = ChangeStore(spark, root)
    query = start_ingest(file_stream(spark, str(tmp_path / "in")), store, f"{root}/checkpoint", "1 second")
    query.processAllAvailable()
    query.stop()
    assert not query.isActive
    assert store.current("orders").count() == 1


def test_replayed_batch_is_skipped(spark, root):
    store = ChangeStore(spark, root)
    batch = frame(spark, [upsert("orders", 0, {"order_id": 1, "customer_id": 1})])
    assert store.apply_batch(batch, 0, "s")
    assert not store.apply_batch(batch, 0, "s")
    assert store.log().count() == 1
    assert store.apply_batch(batch, 0, "another stream")
    assert store.current("orders").count() == 1


def test_topic_that_counts_from_0_again(spark, root):
    store = ChangeStore(spark, root)
    rows = [upsert("orders", 500, {"order_id": 1, "customer_id": 1}), delete("orders", 501, 2)]
    store.apply_batch(frame(spark, rows), 0, "first")
    rows = [upsert("orders", i, {"order_id": i, "customer_id": 7}) for i in (1, 2)]
    store.apply_batch(frame(spark, rows), 0, "second")
    assert {k: v[0] for k, v in order_rows(store.current("orders")).items()} == {1: 7, 2: 7}


def test_each_message_counts_once_in_any_order(spark, root):
    """Offsets that come late are applied; messages that come again, in a batch or later, are not."""
    store = ChangeStore(spark, root)
    late = upsert("orders", 5, {"order_id": 2, "customer_id": 2})
    first = upsert("orders", 10, {"order_id": 1, "customer_id": 1})
    second = upsert("orders", 11, {"order_id": 1, "customer_id": 3})
    bad = message("orders", 12, "{bad")
    store.apply_batch(frame(spark, [first, first, bad]), 0)
    store.apply_batch(frame(spark, [late, second]), 1)
    store.apply_batch(frame(spark, [first, bad, late]), 2)
    assert sorted(r["kafka_offset"] for r in store.log().collect()) == [5, 10, 11]
    assert store.quarantine().count() == 1
    assert {k: v[0] for k, v in order_rows(store.current("orders")).items()} == {1: 3, 2: 2}


def test_topics_do_not_share_offsets(spark, root):
    store = ChangeStore(spark, root)
    one = upsert("orders", 100, {"order_id": 1, "customer_id": 1})
    other = ("b.orders", *upsert("orders", 3, {"order_id": 1, "customer_id": 2})[1:])
    store.apply_batch(frame(spark, [one]), 0)
    store.apply_batch(frame(spark, [other]), 1)
    assert order_rows(store.current("orders"))[1][0] == 2


def test_latest_events_when_the_clock_goes_back(spark, root):
    store = ChangeStore(spark, root)
    for number in range(3):
        batch = [upsert("orders", 10 * number + i, {"order_id": i, "customer_id": 1}) for i in range(3)]
        store.apply_batch(frame(spark, batch), number)
    path = store.folder.path("log", "batch=2")
    held = store._read_log("log", "batch=2").withColumn("processed_at", F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00'"))
    changed = spark.createDataFrame(held.collect(), held.schema).drop("batch")
    changed.write.mode("overwrite").partitionBy("route", "entity").parquet(path)
    expected = [22, 21, 20, 12, 11, 10]
    assert [r["kafka_offset"] for r in store.latest_events(6).collect()] == expected
    assert [r["kafka_offset"] for r in store.latest_events(100).collect()][:6] == expected


def test_failed_batch_is_invisible_and_repeatable(spark, root, monkeypatch):
    store = ChangeStore(spark, root)
    first = [upsert("orders", 0, {"order_id": 1, "customer_id": 1}), upsert("products", 0, {"product_id": 1})]
    second = [delete("orders", 1, 1), upsert("products", 1, {"product_id": 2})]
    store.apply_batch(frame(spark, first), 0)

    append = ChangeStore._append

    def fail_on_products(self, batch, commit, entity):
        if entity.name == "products":
            raise RuntimeError("lost")
        append(self, batch, commit, entity)

    monkeypatch.setattr(ChangeStore, "_append", fail_on_products)
    with pytest.raises(RuntimeError):
        store.apply_batch(frame(spark, second), 1)
    assert (store.log().count(), store.current("orders").count()) == (2, 1)
    monkeypatch.undo()
    assert store.apply_batch(frame(spark, second), 1)
    assert (store.log().count(), store.current("orders").count(), store.current("products").count()) == (4, 0, 2)


def test_a_batch_writes_what_it_changes(spark, root):
    store = ChangeStore(spark, root)
    many = [upsert("customers", i, {"customer_id": i}) for i in range(400)]
    store.apply_batch(frame(spark, many), 0)
    few = [upsert("customers", 400 + i, {"customer_id": 3 + i % 4, "city": f"x{i}"}) for i in range(12)]
    store.apply_batch(frame(spark, few), 1)
    assert store.commit().parts["customers"] == [["0", 400], ["1", 4]]
    rows = {r["customer_id"]: r["city"] for r in store.current("customers").collect()}
    assert len(rows) == 400 and [rows[i] for i in (3, 4, 5, 6, 7)] == ["x8", "x9", "x10", "x11", None]


def test_tables_are_rewritten_when_they_are_outgrown(spark, root, monkeypatch):
    store = ChangeStore(spark, root)
    store.apply_batch(frame(spark, [upsert("customers", i, {"customer_id": i}) for i in range(6)]), 0)
    store.apply_batch(frame(spark, [delete("customers", 6 + i, i) for i in range(4)]), 1)
    assert [p for p, _ in store.commit().parts["customers"]] == ["0", "1"]
    store.apply_batch(frame(spark, [upsert("customers", 20 + i, {"customer_id": 3 + i}) for i in range(3)]), 2)
    assert store.commit().parts["customers"] == [["2-whole", 3]]  # deleted keys are gone
    assert sorted(r["customer_id"] for r in store.current("customers").collect()) == [3, 4, 5]
    monkeypatch.setattr(store_module, "MOST_PARTS", 2)
    for number in range(3, 6):
        store.apply_batch(frame(spark, [upsert("customers", 30 + number, {"customer_id": 5, "city": str(number)})]), number)
    assert len(store.commit().parts["customers"]) <= 2
    assert {r["customer_id"]: r["city"] for r in store.current("customers").collect()} == {3: None, 4: None, 5: "5"}


def test_log_is_a_superset_of_what_is_applied(spark, root):
    store = ChangeStore(spark, root)
    batch = [
        message("orders", 0, None),
        message("orders", 1, "{bad"),
        message("orders", 2, b"\xff"),
        message("orders", 3, {"op": "u", "after": {"order_id": "x"}}),
        upsert("orders", 4, {"order_id": 1, "customer_id": 1}),
        upsert("returns", 5, {"return_id": 1}),
    ]
    store.apply_batch(frame(spark, batch), 0)
    assert sorted(r["kafka_offset"] for r in store.log().collect()) == [3, 4, 5]
    assert {r["kafka_offset"]: r["reason"] for r in store.quarantine().collect()} == {
        1: "invalid json", 2: "invalid utf-8", 3: "missing or unreadable key",
    }
    assert store.current("orders").count() == 1


def test_batch_without_anything_to_apply(spark, root):
    store = ChangeStore(spark, root)
    assert store.apply_batch(frame(spark, []), 0)
    assert store.apply_batch(frame(spark, [message("orders", 0, "{bad")]), 1)
    assert store.current("orders").count() == 0
    assert store.quarantine().count() == 1


def test_latest_events_over_several_batches(spark, root):
    store = ChangeStore(spark, root)
    for number in range(3):
        batch = [upsert("orders", 10 * number + i, {"order_id": i, "customer_id": 1}) for i in range(4)]
        store.apply_batch(frame(spark, batch), number)
    assert [r["kafka_offset"] for r in store.latest_events(6).collect()] == [23, 22, 21, 20, 13, 12]
    assert store.latest_events(100).count() == 12


def test_vacuum_keeps_what_is_in_use(spark, root):
    store = ChangeStore(spark, root)
    messages = random_messages(5, count=120)
    for number in range(4):
        store.apply_batch(frame(spark, messages[30 * number : 30 * number + 30]), number)
    assert store.vacuum(keep=1) > 0
    assert store.commit_numbers() == [3]
    assert order_rows(store.current("orders")) == fold_orders(messages)
    assert store.log().count() == 120
    assert store.vacuum(keep=1) == 0


def test_commit_size_is_bounded(spark, root, monkeypatch):
    monkeypatch.setattr(store_module, "_RECENT_BATCHES", 2)
    store = ChangeStore(spark, root)
    for number in range(3):
        store.apply_batch(frame(spark, [upsert("orders", number, {"order_id": 1, "customer_id": 1})]), number)
    assert len(store.commit().recent) == 2
    assert store.latest_events(30).count() == 3


def test_views_and_missing_tables(spark, root):
    store = ChangeStore(spark, root)
    for name in ("orders_current", "raw_cdc_events"):
        spark.catalog.dropTempView(name)
    assert "orders_current" in missing_tables(spark)
    with pytest.raises(LookupError, match="orders_current"):
        catalog_tables(spark)
    store.apply_batch(frame(spark, [upsert("orders", 0, {"order_id": 1, "customer_id": 1})]), 0)
    store.register_views()
    assert missing_tables(spark) == []
    assert catalog_tables(spark).orders.count() == 1
    assert spark.sql("SELECT count(*) AS n FROM raw_cdc_events").first()["n"] == 1


def test_include_list(spark):
    messages = frame(spark, [upsert(e, 0, {}) for e in ("orders", "returns", "payments")])
    kept = only_topics(messages, topics("shop.public", ["orders", "payments"]))
    assert sorted(r["topic"] for r in kept.collect()) == ["shop.public.orders", "shop.public.payments"]
