"""Stored layouts, SQL with bound values, observed counts, digests: results and plans."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.small_tables import empty_tables, tables
from tidemark.operators import capture, mutations, quality
from tidemark.plans import dashboard, marts, parametric
from tidemark.plans.dashboard import Filters
from tidemark.schemas import ENTITIES
from tidemark.sources import layouts

ORDERS = ENTITIES["orders"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def held(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture
def joins_shuffle(spark):
    """No side is small enough to be sent to all tasks."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_bucketed_tables_join_without_a_shuffle(spark, joins_shuffle):
    source = tables(spark)
    layouts.save_bucketed(source, "bucketed_test_", 4)
    saved = layouts.bucketed_tables(spark, "bucketed_test_")
    for name in ENTITIES:
        assert held(saved.table(name)) == held(source.table(name)), name
    totals = mutations.reconcile_totals(saved.orders, saved.order_items)
    assert "Exchange" not in plan_of(totals) and "Exchange" in plan_of(mutations.reconcile_totals(source.orders, source.order_items))
    assert held(totals) == held(mutations.reconcile_totals(source.orders, source.order_items))
    paid = saved.payments.join(saved.orders, "order_id").join(saved.order_items, "order_id")
    assert "Exchange" not in plan_of(paid)
    for name in ENTITIES:
        spark.sql(f"DROP TABLE bucketed_test_{name}")


def test_only_selected_months_are_read(spark, tmp_path):
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1), None]
    orders = spark.createDataFrame([(i, i % 7, None if d is None else f"{d} 10:00:00", "placed", 1.0) for i, d in enumerate(days * 9)], "order_id long, customer_id long, t string, status string, total_amount double")
    orders = orders.select("order_id", "customer_id", F.col("t").cast("timestamp_ntz").alias("order_ts"), "status", "total_amount")
    path = str(tmp_path / "orders")
    layouts.save_by_month(orders, path)
    assert held(layouts.orders_between(spark, path)) == held(orders)
    picked = Filters(start=date(2024, 2, 5), end=date(2024, 2, 29))
    found = picked.orders(layouts.orders_between(spark, path, picked.start, picked.end))
    assert held(found) == held(picked.orders(orders)) and found.count() == 9
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "order_month" in filters and "2024-02-01" in filters and "2024-02-29" in filters
    months = {f.split("order_month=")[1].split("/")[0] for (f,) in found.select(F.input_file_name()).distinct().collect()}
    assert months == {"2024-02-01"}
    wanted = spark.createDataFrame([(date(2024, 3, 1), "x"), (date(2024, 1, 1), "y")], "order_month date, note string").where("note = 'x'")
    dynamic = layouts.orders_in_months(spark, path, wanted)
    assert held(dynamic) == held(orders.where("month(order_ts) = 3"))


def test_plans_show_filters_of_long_names_whole(spark, tmp_path):
    path, name = str(tmp_path / "long"), "month_" + "x" * 60
    spark.createDataFrame([(1, date(2024, 2, 1)), (2, date(2024, 3, 1))], f"order_id long, {name} date").write.partitionBy(name).parquet(path)
    found = spark.read.parquet(path).where(F.col(name).between(date(2024, 2, 1), date(2024, 2, 29)))
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-02-01" in filters and "2024-02-29" in filters and found.count() == 1


def test_months_known_at_run_time_prune_the_scan(spark, tmp_path):
    """The months come from a stored table with a filter of its own."""
    orders = tables(spark).orders
    layouts.save_by_month(orders, str(tmp_path / "orders"))
    months = orders.where("order_ts is not null").select(F.trunc(F.to_date("order_ts"), "month").alias("order_month"), F.lit("x").alias("note")).distinct()
    months.write.parquet(str(tmp_path / "months"))
    picked = spark.read.parquet(str(tmp_path / "months")).where("note = 'x'")
    found = layouts.orders_in_months(spark, str(tmp_path / "orders"), picked)
    assert "dynamicpruning" in plan_of(found)
    assert held(found) == held(orders.where("order_ts is not null"))


@pytest.mark.parametrize("filters", [
    Filters(), Filters(("city0", "city1"), ("placed", "canceled", "refunded"), ("cat0", "cat2"), date(2024, 3, 10), date(2024, 3, 11)),
    Filters(cities=()), Filters(statuses=("placed",)), Filters(start=date(2024, 3, 11)),
])
@pytest.mark.parametrize("source", [tables, empty_tables])
def test_kpi_row_with_bound_values(spark, source, filters):
    held_tables = source(spark)
    assert held(parametric.kpi_row(spark, held_tables, filters)) == held(dashboard.kpi_row(held_tables, filters))


def test_quotes_in_values_do_no_harm(spark):
    names = ["it's", "' OR '1'='1", "a\"b", "x); DROP TABLE y --", ":start", "{orders}", "ö"]
    products = spark.createDataFrame([(i, n, "c", 1.0) for i, n in enumerate(names)], ENTITIES["products"].schema)
    base = dict(empty_tables(spark).items()) | {"products": products}
    text = "SELECT product_id FROM {products} WHERE product_name = :name"
    for i, name in enumerate(names):
        found = parametric.query(spark, parametric.Tables(**base), text, name=name).collect()
        assert [r["product_id"] for r in found] == [i]


def test_watched_frames_count_what_runs(spark, tmp_path):
    orders = tables(spark).orders
    watched = quality.Watched(orders, "orders", ["status", "customer_id"])
    watched.frame.write.parquet(str(tmp_path / "orders"))
    assert watched.row_count == orders.count()
    assert held(quality.watched_checks(spark, [watched])) == held(quality.not_null(orders, "orders", ["status", "customer_id"]))
    nothing = quality.Watched(empty_tables(spark).orders, "orders", ["status"])
    nothing.frame.write.parquet(str(tmp_path / "empty"))
    assert nothing.row_count == 0 and nothing.checks() == [("not_null_orders_status", 0)]


def test_built_marts_come_with_their_checks(spark, tmp_path):
    built = marts.build_marts(tables(spark), str(tmp_path), list(marts.NOT_NULL))
    assert held(quality.watched_checks(spark, built)) == held(marts.check_marts(spark, str(tmp_path)))
    assert {w.name: w.row_count for w in built} == {n: spark.read.parquet(f"{tmp_path}/{n}").count() for n in marts.NOT_NULL}


def test_digests_find_the_same_differences(spark):
    old = tables(spark).orders
    later = [(900, 1, None, "placed", 2.0), (None, 5, None, "lost", 1.0)]
    new = old.where("order_id % 3 <> 0 or order_id is null").withColumn("status", F.when(F.col("order_id") == 4, None).otherwise(F.col("status")))
    new = new.unionByName(spark.createDataFrame(later, ORDERS.schema))
    for a, b in ((old, new), (new, old), (old, old), (old, old.limit(0)), (old.limit(0), new)):
        plain = capture.table_changes(a, b, ORDERS)
        assert held(capture.table_changes(*capture.differing(a, b, ORDERS), ORDERS)) == held(plain)


def test_digests_come_before_whole_rows(spark, joins_shuffle, tmp_path):
    """The first shuffle holds keys and digests; whole rows are only fetched for the keys found."""
    old = tables(spark).orders
    old.write.parquet(str(tmp_path / "old"))
    stored = spark.read.parquet(str(tmp_path / "old"))
    first, _ = capture.differing(stored, stored.withColumn("status", F.lit("x")), ORDERS)
    optimized = first._jdf.queryExecution().optimizedPlan().toString()
    full = optimized[optimized.index("FullOuter"):]
    sides = [line for line in full.split("\n")[1:] if "Project" in line][:2]
    assert len(sides) == 2 and all("_key" in line and "total_amount#" not in line.split("xxhash64")[0] for line in sides)
