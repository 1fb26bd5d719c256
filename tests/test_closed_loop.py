"""What the closed loop of captures and store shuffles."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import capture
from tidemark.schemas import ENTITIES
from tidemark.sources import layouts
from tidemark.sources.tables import Tables
from tidemark.streaming.store import ChangeStore

ORDERS = ENTITIES["orders"]


def orders(spark, ids):
    return spark.createDataFrame([(i, i % 5, datetime(2024, 1, 1 + i % 28), "placed", float(i)) for i in ids], ORDERS.schema)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_versions_of_saved_tables_are_compared_without_a_shuffle(spark):
    prefix = f"t_{uuid.uuid4().hex}_"
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        empty = {name: None for name in ENTITIES}
        layouts.save_bucketed(Tables(**empty | {"orders": orders(spark, range(200))}), prefix, None, ["orders"], {"orders": "order_id"})
        saved = layouts.bucketed_tables(spark, prefix).orders
        changed = saved.where("order_id % 11 != 0").withColumn("status", F.lit("shipped"))
        found = capture.diff_events(saved, changed, ORDERS, "p", capture=1)
        assert "Exchange" not in plan_of(found) and found.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.sql(f"DROP TABLE IF EXISTS {prefix}orders")


@pytest.mark.parametrize("ids", [list(range(50)), [*range(50), 3, 3, 7]])
def test_changes_expected_once_per_key(spark, tmp_path, ids):
    """Where keys do repeat, the changes are folded as without the expectation."""
    first = capture.snapshot_events(orders(spark, ids), ORDERS, "p")
    second = capture.diff_events(orders(spark, range(50)), orders(spark, range(2, 52)), ORDERS, "p", capture=1)
    stores = [ChangeStore(spark, str(tmp_path / str(once))) for once in (True, False)]
    for once, store in zip((True, False), stores):
        for number, messages in enumerate((first, second)):
            assert store.apply_batch(messages, number, unique=True, once_per_key=once)
    new, old = (sorted(map(tuple, s.current("orders").collect())) for s in stores)
    assert new == old and len(new) == 50
    few = stores[0].current("orders", ["order_id", "status"])
    assert sorted(map(tuple, few.collect())) == sorted((r[0], r[3]) for r in old)
    names = [part for part, _ in stores[0].commit().parts["orders"]]
    assert names[0] == ("0" if len(ids) == 50 else "0-folded")
    assert [rows for _, rows in stores[0].commit().parts["orders"]] == [rows for _, rows in stores[1].commit().parts["orders"]]
