"""Bulk changes, captured as events and folded back: the loop must close."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.small_tables import empty_tables, rows, tables
from tidemark.operators import capture, decode, mutations, numbering, quality, sampling, state
from tidemark.schemas import ENTITIES
from tidemark.sources.tables import row_counts, show_tables, to_pandas
from tidemark.sources.changes import file_stream
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.store import ChangeStore


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_snapshot_then_changes_through_a_store(spark, tmp_path):
    before = tables(spark)
    orders = mutations.refund_random(mutations.deliver_latest_shipped(mutations.ship_latest(before.orders)))
    after = {
        "customers": mutations.upgrade_random_customers(before.customers),
        "products": mutations.uplift_prices(before.products).where("product_id <> 3"),
        "orders": orders,
        "order_items": before.order_items.where("order_id is not null"),
        "payments": mutations.refund_payments(before.payments, orders),
    }
    store = ChangeStore(spark, str(tmp_path / "store"))
    valid = {
        "orders": before.orders.where("customer_id is not null"),
        "order_items": before.order_items.where("order_id is not null"),
    }
    after["orders"] = after["orders"].where("customer_id is not null")
    for number, (name, entity) in enumerate(ENTITIES.items()):
        source = valid.get(name, getattr(before, name))
        store.apply_batch(capture.snapshot_events(source, entity, "shop.public", partitions=2), number, "snapshot")
        assert same(store.current(name), source), name
    for number, (name, entity) in enumerate(ENTITIES.items()):
        source = valid.get(name, getattr(before, name))
        events = capture.diff_events(source, after[name], entity, "shop.public", partitions=2, capture=1)
        store.apply_batch(events, len(ENTITIES) + number, "snapshot")
        assert same(store.current(name), after[name]), name
    for number, (name, entity) in enumerate(ENTITIES.items()):
        source = valid.get(name, getattr(before, name))
        events = capture.diff_events(after[name], source, entity, "shop.public", partitions=2, capture=2)
        store.apply_batch(events, 2 * len(ENTITIES) + number, "snapshot")
        assert same(store.current(name), source), name


def test_captures_through_landed_files(spark, tmp_path):
    source = tables(spark).products
    versions = [source, mutations.uplift_prices(source), source.where("product_id <> 3")]
    store = ChangeStore(spark, str(tmp_path / "store"))
    for number, version in enumerate(versions):
        events = (
            capture.diff_events(versions[number - 1], version, ENTITIES["products"], "p", capture=number)
            if number else capture.snapshot_events(version, ENTITIES["products"], "p")
        )
        events.write.mode("append").parquet(str(tmp_path / "in"))
        ingest_available(file_stream(spark, str(tmp_path / "in")), store, str(tmp_path / "checkpoint"))
        assert same(store.current("products"), version)


def test_snapshot_rows_that_break_rules_are_rejected(spark):
    messages = capture.snapshot_events(tables(spark).orders, ENTITIES["orders"], "shop.public")
    changes = decode.decode_changes(decode.log_rows(decode.route_messages(messages)), ENTITIES["orders"])
    lost = sum(1 for r in rows()["orders"] if r[1] is None)
    assert lost > 0 and changes.where("action = 'reject'").count() == lost


def test_diff_of_equal_tables_is_empty(spark):
    source = tables(spark)
    assert capture.diff_events(source.orders, source.orders, ENTITIES["orders"], "p", capture=1).count() == 0


def test_progression(spark):
    orders = tables(spark).orders
    latest = [r[0] for r in sorted((r for r in rows()["orders"] if r[2]), key=lambda r: r[2], reverse=True)]
    nulls = [r[0] for r in rows()["orders"] if r[2] is None]
    shipped = mutations.ship_latest(orders, 5)
    changed = {r["order_id"] for r in shipped.exceptAll(orders).collect()}
    # As in a database, a missing time sorts first in descending order.
    expected = (nulls + latest)[:5]
    already = {r[0] for r in rows()["orders"] if r[3] == "shipped"}
    assert changed == set(expected) - already


def test_refunds_reach_payments_and_keep_amounts(spark):
    source = tables(spark)
    paid = mutations.refund_payments(source.payments, source.orders)
    refunded = {r[0] for r in rows()["orders"] if r[3] == "refunded"}
    for row in paid.collect():
        original = rows()["payments"][row["payment_id"] - 1]
        assert row["amount"] == original[4]
        assert row["payment_status"] == ("refunded" if row["order_id"] in refunded else original[3])


def test_update_by_keys_survives_repeated_and_missing_keys(spark):
    source = tables(spark).customers
    keys = spark.createDataFrame([(1,), (1,), (99,), (None,)], "customer_id long")
    changed = mutations.set_where_key_in(source, keys, "customer_id", "city", F.lit("x"))
    assert changed.count() == source.count()
    assert [r["customer_id"] for r in changed.where("city = 'x'").collect()] == [1]


def test_uplift_rounds_to_cents(spark):
    frame = spark.createDataFrame([(2, 35.0), (5, 65.55), (9, 88.99), (3, 10.01)], "product_id long, unit_price double")
    prices = {r["product_id"]: r["unit_price"] for r in mutations.uplift_prices(frame).collect()}
    assert prices == {2: 37.8, 5: 70.79, 9: 96.11, 3: 10.01}


def test_payments_from_orders(spark):
    found = {r["order_id"]: r for r in mutations.payments_from_orders(tables(spark).orders).collect()}
    for order_id, _, ts, status, amount in rows()["orders"]:
        row = found[order_id]
        assert row["payment_status"] == {"canceled": "voided", "refunded": "refunded"}.get(status, "paid")
        assert row["amount"] == (0.0 if status == "canceled" else amount)
        assert row["payment_ts"] == (ts and ts + timedelta(minutes=5))


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbering_is_dense_and_ordered(spark, partitions):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(partitions)
    base = spark.createDataFrame([(41,)], "id long")
    numbered = numbering.number_rows(frame, base, "id", ["k"]).orderBy("k").collect()
    assert [r["id"] for r in numbered] == list(range(42, 1042))


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "k long")
    assert numbering.number_rows(empty, empty.withColumnRenamed("k", "id"), "id", ["k"]).count() == 0
    assert numbering.next_key(empty, "k").first()["next_key"] == 1


def test_new_orders_are_consistent(spark):
    source = tables(spark)
    carts = spark.createDataFrame(
        [("b", 1, 1, 2), ("b", 1, 2, 1), ("a", 2, 3, 1), ("a", 2, 77, 1)],
        "cart string, customer_id long, product_id long, quantity long",
    ).withColumn("order_ts", F.expr("TIMESTAMP_NTZ '2024-05-01 10:00:00'"))
    orders, items, payments = mutations.new_orders(carts, source)
    assert {(r["order_id"], r["customer_id"], r["total_amount"]) for r in orders.collect()} == {
        (61, 2, 13.0), (62, 1, 34.0),
    }
    assert sorted((r["order_item_id"], r["order_id"], r["product_id"]) for r in items.collect()) == [
        (9003, 61, 3), (9004, 62, 1), (9005, 62, 2),
    ]
    assert sorted((r["payment_id"], r["order_id"], r["amount"]) for r in payments.collect()) == [
        (61, 61, 13.0), (62, 62, 34.0),
    ]
    checked = mutations.reconcile_totals(orders, items)
    assert [r["difference"] for r in checked.collect()] == [0.0, 0.0]


def test_a_cart_of_two_customers_is_two_orders(spark):
    carts = spark.createDataFrame(
        [("c", 1, 1, 1), ("c", 2, 2, 1), ("c", None, 3, 1)], "cart string, customer_id long, product_id long, quantity long"
    ).withColumn("order_ts", F.expr("TIMESTAMP_NTZ '2024-05-01 10:00:00'"))
    orders, items, payments = mutations.new_orders(carts, tables(spark))
    assert (orders.count(), items.count(), payments.count()) == (3, 3, 3)
    assert {r["difference"] for r in mutations.reconcile_totals(orders, items).collect()} == {0.0}


def test_orders_without_lines_reconcile_to_zero(spark):
    source = tables(spark)
    checked = mutations.reconcile_totals(source.orders, source.order_items)
    assert checked.count() == 60
    empty = [r for r in checked.collect() if r["line_count"] == 0]
    assert empty and all(r["line_total"] == 0 for r in empty)


def test_random_k_is_repeatable(spark):
    frame = spark.range(500)
    first = {r["id"] for r in sampling.random_k(frame, 20, "id", 1).collect()}
    assert first == {r["id"] for r in sampling.random_k(frame.repartition(9), 20, "id", 1).collect()}
    assert len(first) == 20 and first != {r["id"] for r in sampling.random_k(frame, 20, "id", 2).collect()}


def test_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "k long, v string")
    results = quality.run_suite([quality.not_null(frame, "t", ["k", "v"]), quality.unique(frame, "t", "k")])
    assert {r["check_name"]: (r["failures"], r["should_error"]) for r in results.collect()} == {
        "not_null_t_k": (1, True), "not_null_t_v": (2, True), "unique_t_k": (1, True),
    }
    with pytest.raises(quality.CheckFailed, match="unique_t_k: 1"):
        quality.require_passed(results)
    quality.require_passed(quality.not_null(frame.where("k is not null"), "t", ["k"]))


def test_table_helpers(spark):
    counts = {r["table_name"]: r["row_count"] for r in row_counts(tables(spark).items()).collect()}
    assert counts == {name: len(data) for name, data in rows().items()}
    assert all(r["row_count"] == 0 for r in row_counts(empty_tables(spark).items()).collect())
    spark.range(3).createOrReplaceTempView("shown_table")
    assert "shown_table" in show_tables(spark)
    assert len(to_pandas(spark.range(3), 3)) == 3
    with pytest.raises(ValueError):
        to_pandas(spark.range(4), 3)


def test_latest_versions_of_snapshot(spark):
    source = tables(spark).products
    messages = capture.snapshot_events(source, ENTITIES["products"], "p")
    changes = decode.decode_changes(decode.log_rows(decode.route_messages(messages)), ENTITIES["products"])
    assert same(state.live_rows(state.latest_changes(changes, ENTITIES["products"]), ENTITIES["products"]), source)
