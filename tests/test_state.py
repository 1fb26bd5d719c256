"""Folding changes into current rows: against a one-at-a-time model."""

from __future__ import annotations

import random

import pytest

from tests.changes import delete, fold_orders, frame, order_rows, upsert
from tidemark.operators import decode, state
from tidemark.schemas import ENTITIES

ORDERS = ENTITIES["orders"]


def random_messages(seed, count=300, keys=12, partitions=3, start=0):
    """Changes in processing order; a key always uses the same partition."""
    rng = random.Random(seed)
    found = []
    for offset in range(start, start + count):
        key = 1 if rng.random() < 0.4 else rng.randrange(keys)
        kind = rng.random()
        partition = key % partitions
        if kind < 0.2:
            found.append(delete("orders", offset, key, partition))
        elif kind < 0.3:
            found.append(upsert("orders", offset, {"order_id": key, "customer_id": None}, partition=partition))
        else:
            after = {"order_id": key, "customer_id": rng.randrange(5), "status": rng.choice("abc")}
            if rng.random() < 0.7:
                after["total_amount"] = rng.randrange(1000) / 4
            found.append(upsert("orders", offset, after, partition=partition))
    return found


def decoded(spark, messages):
    return decode.decode_changes(decode.log_rows(decode.route_messages(frame(spark, messages))), ORDERS)


def versions(spark, messages):
    return state.latest_changes(decoded(spark, messages), ORDERS)


@pytest.mark.parametrize("seed", range(4))
def test_latest_changes_match_the_model(spark, seed):
    messages = random_messages(seed)
    shuffled = random.Random(seed).sample(messages, len(messages))
    result = state.live_rows(versions(spark, shuffled), ORDERS)
    assert order_rows(result) == fold_orders(messages)


@pytest.mark.parametrize("order", [[0, 1, 2], [0, 2, 1], [2, 1, 0]])
def test_batches_count_in_the_order_of_merging(spark, order):
    messages = random_messages(7)
    batches = [messages[:100], messages[100:200], messages[200:]]
    merged = None
    for i in order:
        incoming = versions(spark, batches[i])
        merged = incoming if merged is None else state.merge_versions(merged, incoming, ORDERS)
    processed = [m for i in order for m in batches[i]]
    assert order_rows(state.live_rows(merged, ORDERS)) == fold_orders(processed)


def test_topics_count_by_name_within_a_batch(spark):
    first = upsert("orders", 100, {"order_id": 1, "customer_id": 1})
    other = ("z.public.orders", *upsert("orders", 3, {"order_id": 1, "customer_id": 2})[1:])
    assert order_rows(state.live_rows(versions(spark, [other, first]), ORDERS))[1][0] == 2


def test_key_from_another_partition_is_newer(spark):
    old = [upsert("orders", 1000, {"order_id": 1, "customer_id": 1}, partition=0)]
    new = [upsert("orders", 3, {"order_id": 1, "customer_id": 2}, partition=5)]
    merged = state.merge_versions(versions(spark, old), versions(spark, new), ORDERS)
    assert order_rows(state.live_rows(merged, ORDERS))[1][0] == 2


def test_rejected_change_leaves_the_earlier_one(spark):
    messages = [
        upsert("orders", 1, {"order_id": 1, "customer_id": 1, "status": "good"}),
        upsert("orders", 2, {"order_id": 1, "customer_id": "x", "status": "bad"}),
    ]
    assert order_rows(state.live_rows(versions(spark, messages), ORDERS)) == {1: (1, "good", None)}


def test_later_offset_wins_over_later_time(spark):
    first = upsert("orders", 1, {"order_id": 1, "customer_id": 1})
    second = upsert("orders", 2, {"order_id": 1, "customer_id": 2})
    second = (*second[:3], bytearray(bytes(second[3]).replace(b'"ts_ms": 2', b'"ts_ms": -50')))
    assert order_rows(state.live_rows(versions(spark, [first, second]), ORDERS))[1][0] == 2


def test_apply_changes_to_plain_rows(spark):
    rows = [(1, 1, None, "a", 1.0), (2, 1, None, "a", 1.0)]
    base = spark.createDataFrame(rows, ORDERS.schema)
    messages = [delete("orders", 1, 1), upsert("orders", 2, {"order_id": 3, "customer_id": 4})]
    result = state.apply_changes(base, decoded(spark, messages), ORDERS)
    assert order_rows(result) == {2: (1, "a", 1.0), 3: (4, None, None)}


def test_parts_are_folded_with_one_shuffle(spark):
    batch = versions(spark, random_messages(1)).persist()
    merged = state.merge_versions(batch, batch, ORDERS)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    batch.unpersist()
    assert plan.split("InMemoryTableScan")[0].count("Exchange") == 1
