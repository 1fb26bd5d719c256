"""Every query by name, as a function of a session and a folder with the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import money, time
from tidemark.operators import capture, decode, mutations, numbering, quality, sampling, state
from tidemark.plans import dashboard, marts, parametric
from tidemark.plans.dashboard import ORDER, Filters
from tidemark.schemas import ENTITIES
from tidemark.session import configure, scratch_path
from tidemark.sources import changes, layouts, testdata
from tidemark.sources import tables as table_set
from tidemark.sources.tables import Tables
from tidemark.streaming import stateful
from tidemark.streaming.ingest import ingest_available
from tidemark.streaming.store import ChangeStore

Query = Callable[[SparkSession, str], DataFrame]

# Selections for the filtered variants.
SELECTED = Filters(
    cities=tuple(f"NATION_{i}" for i in range(10)),
    statuses=("placed", "canceled"),
    categories=("ECONOMY", "SMALL", "PROMO"),
    start=date(1996, 1, 1),
    end=date(1998, 12, 31),
)
NOTHING = Filters(cities=())

ORDERS = ENTITIES["orders"]


def _on_tables(plan: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(testdata.load(configure(spark), folder))

    return run


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return decode.log_rows(decode.route_messages(testdata.messages(configure(spark), folder)))


def _state(name: str) -> Query:
    entity = ENTITIES[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        changed = decode.message_changes(testdata.messages(configure(spark), folder), entity)
        return state.live_rows(state.latest_changes(changed, entity), entity)

    return run


def _streamed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of messages into a store; the resulting orders table."""
    configure(spark)
    events = testdata.event_stream(spark, folder)
    root = scratch_path(spark, "store")
    store = ChangeStore(spark, root)
    ingest_available(testdata.change_messages(events), store, f"{root}/checkpoint")
    return store.current("orders")


def _stored_flawed(spark: SparkSession, folder: str) -> ChangeStore:
    """A store fed with flawed messages in three batches, and with a part of them again in a fourth."""
    messages = testdata.flawed_messages(testdata.events(configure(spark), folder))
    store = ChangeStore(spark, scratch_path(spark, "store"))
    for number in range(3):
        store.apply_batch(messages.where(F.col("offset") % 3 == number), number)
    store.apply_batch(messages.where(F.col("offset") % 7 == 0), 3)
    return store


def _quarantined(spark: SparkSession, folder: str) -> DataFrame:
    found = _stored_flawed(spark, folder).quarantine()
    return found.groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("messages"))


def _stored_log(spark: SparkSession, folder: str) -> DataFrame:
    log = _stored_flawed(spark, folder).log()
    timed = F.col("processed_at").isNotNull().alias("timed")
    return log.select("entity", "kafka_topic", "kafka_partition", "kafka_offset", "op", timed)


def _loop_versions(tables: Tables) -> list[dict[str, DataFrame]]:
    """Three versions of the five tables: as they are, with progress, with refunds and dearer products."""
    first = {name: frame for name, frame in tables.items()}
    status = F.when(F.col("status") == "placed", "shipped").otherwise(F.col("status"))
    orders = first["orders"].where(F.col("order_id") % 11 != 0).withColumn("status", status)
    second = first | {
        "orders": orders,
        "order_items": first["order_items"].where(F.col("order_id") % 11 != 0),
        "customers": first["customers"].withColumn("loyalty_tier", F.when(F.col("customer_id") % 5 == 0, "Gold").otherwise(F.col("loyalty_tier"))),
    }
    third = second | {
        "orders": orders.withColumn("status", F.when(F.col("order_id") % 7 == 0, "refunded").otherwise(F.col("status"))),
        "payments": first["payments"].withColumn("payment_status", F.when(F.col("order_id") % 7 == 0, "refunded").otherwise(F.col("payment_status"))),
        "products": first["products"].where(F.col("product_id") % 13 != 0),
    }
    return [first, second, third]


def _closed_loop(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot and two captured changes of all tables through one stream; what the store then holds.

    The tables are saved by key first: the versions come from the saved rows, and comparing them shuffles nothing.
    """
    prefix = f"tidemark_{uuid.uuid4().hex}_"
    layouts.save_bucketed(testdata.load(configure(spark), folder), prefix, None, keys={name: entity.key for name, entity in ENTITIES.items()})
    versions = _loop_versions(layouts.bucketed_tables(spark, prefix))
    store = ChangeStore(spark, scratch_path(spark, "store"))
    shown = {"customers": "loyalty_tier", "products": "category", "orders": "status", "order_items": "product_id", "payments": "payment_status"}
    for number, messages in enumerate(_captured(versions)):
        store.apply_batch(messages, number, unique=True, once_per_key=True)
    current = [
        store.current(name, [entity.key, shown[name]]).select(F.lit(name).alias("entity"), F.col(entity.key).alias("key"), F.col(shown[name]).cast("string").alias("state"))
        for name, entity in ENTITIES.items()
    ]
    return reduce(DataFrame.unionByName, current)


def _kept_versions(tables: Tables) -> list[dict[str, DataFrame]]:
    """Three versions of orders and customers: as they are; progress and removed orders; other amounts, customers who moved or left."""
    first = {"orders": tables.orders, "customers": tables.customers}
    status = F.when(F.col("status") == "placed", "canceled").otherwise(F.col("status"))
    second = first | {"orders": first["orders"].where(F.col("order_id") % 11 != 0).withColumn("status", F.when(F.col("order_id") % 5 == 0, status).otherwise(F.col("status")))}
    amount = F.when(F.col("order_id") % 4 == 0, F.col("total_amount") + 16.0).otherwise(F.col("total_amount"))
    third = {
        "orders": second["orders"].where(F.col("order_id") % 7 != 0).withColumn("total_amount", amount),
        "customers": first["customers"].where(F.col("customer_id") % 17 != 0).withColumn("city", F.when(F.col("customer_id") % 10 == 3, "NATION_0").otherwise(F.col("city"))),
    }
    return [first, second, third]


def _captured(versions: list[dict[str, DataFrame]]) -> list[DataFrame]:
    """The snapshot of the first version and what changes to the later ones, all tables together."""
    found = []
    for number, tables in enumerate(versions):
        captured = [
            capture.diff_events(versions[number - 1][name], frame, ENTITIES[name], testdata.TOPIC_PREFIX, capture=number)
            if number else capture.snapshot_events(frame, ENTITIES[name], testdata.TOPIC_PREFIX)
            for name, frame in tables.items()
        ]
        found.append(reduce(DataFrame.unionByName, captured))
    return found


def _kept_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Marts that three captured batches have kept up to date, never built from the tables."""
    store = ChangeStore(spark, scratch_path(spark, "store"), keep_marts=True)
    for number, messages in enumerate(_captured(_kept_versions(testdata.load(configure(spark), folder)))):
        store.apply_batch(messages, number, unique=True, once_per_key=True)
    found = []
    for name, (group, orders) in {"hourly_kpis": ("order_hour", "orders"), "orders_summary": ("status", "order_count"), "revenue_by_city": ("city", "orders")}.items():
        mart = store.kept_mart(name)
        label = F.date_format(group, "yyyy-MM-dd HH:mm:ss") if name == "hourly_kpis" else F.col(group)
        found.append(mart.select(F.lit(name).alias("mart"), label.alias("label"), F.col(orders).alias("orders"), "revenue", "avg_order_value"))
    return reduce(DataFrame.unionByName, found)


def _landed(messages: DataFrame, name: str, files: int) -> str:
    """Messages in files of ascending offsets, as a connector lands them."""
    path = scratch_path(messages.sparkSession, name)
    messages.repartitionByRange(files, "offset").write.parquet(path)
    return path


def _stateful_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that a query holds in its state after four batches of landed messages."""
    landed = _landed(testdata.messages(configure(spark), folder), "landed", 4)
    written = scratch_path(spark, "state-rows")
    query = stateful.start_state(changes.file_stream(spark, landed, files_per_batch=1), ORDERS, written, scratch_path(spark, "state-checkpoint"))
    query.awaitTermination()
    return stateful.read_state(spark, ORDERS, written)


def _deduplicated_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of landed messages with repeats within a batch and in later batches, each let through once by the query's state."""
    messages = testdata.flawed_messages(testdata.events(configure(spark), folder))
    landed = _landed(messages, "landed", 3)
    messages.where(F.col("offset") % 7 == 0).coalesce(1).write.mode("append").parquet(landed)
    store = ChangeStore(spark, scratch_path(spark, "store"))
    ingest_available(changes.file_stream(spark, landed, files_per_batch=1), store, scratch_path(spark, "log-checkpoint"))
    return store.log().select("entity", "kafka_topic", "kafka_partition", "kafka_offset", "op", F.col("processed_at").isNotNull().alias("timed"))


def _op_counts(spark: SparkSession, folder: str) -> DataFrame:
    log = _log(spark, folder)
    return log.groupBy("entity", "op").agg(F.count(F.lit(1)).alias("events"))


def _raw_log(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder).drop("processed_at")


def _latest_events(k: int) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        routed = decode.route_messages(testdata.messages(configure(spark), folder), ["route", *dashboard.EVENT_COLUMNS])
        return dashboard.latest_events(routed.where(F.col("route") == decode.LOG), k).drop("processed_at")

    return run


def _old_orders(tables: Tables) -> DataFrame:
    return tables.orders.where(F.col("status") != "refunded")


def _new_orders(tables: Tables) -> DataFrame:
    """A later version: canceled orders gone, refunded ones new, placed ones shipped."""
    status = F.when(F.col("status") == "placed", "shipped").otherwise(F.col("status"))
    return tables.orders.where(F.col("status") != "canceled").withColumn("status", status)


def _decoded_orders(messages: DataFrame) -> DataFrame:
    return decode.decode_changes(decode.log_rows(decode.route_messages(messages)), ORDERS)


def _snapshot(tables: Tables) -> DataFrame:
    messages = capture.snapshot_events(tables.orders, ORDERS, testdata.TOPIC_PREFIX)
    return _decoded_orders(messages).drop(*decode.POSITION)


def _diff(tables: Tables) -> DataFrame:
    messages = capture.diff_events(
        _old_orders(tables), _new_orders(tables), ORDERS, testdata.TOPIC_PREFIX, capture=1
    )
    return _decoded_orders(messages).drop(*decode.POSITION)


def _few_diff(tables: Tables) -> DataFrame:
    """The difference of two versions of which one order in a hundred changed, found by digests."""
    number = F.col("order_id") % 300
    status = F.when(number == 100, "shipped").otherwise(F.col("status"))
    old, new = tables.orders.where(number != 200), tables.orders.where(number != 0).withColumn("status", status)
    return _decoded_orders(capture.diff_events(old, new, ORDERS, testdata.TOPIC_PREFIX, capture=1, few=True)).drop(*decode.POSITION)


def _merged(tables: Tables) -> DataFrame:
    old, new = _old_orders(tables), _new_orders(tables)
    changes = _decoded_orders(capture.diff_events(old, new, ORDERS, testdata.TOPIC_PREFIX, capture=1))
    return state.apply_changes(old, changes, ORDERS)


def _star_totals(tables: Tables) -> DataFrame:
    return (
        dashboard.star(tables, SELECTED)
        .groupBy("city", "category", "status")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
            *money.sum_parts(F.col("line_amount"), "line"),
        )
        .select("city", "category", "status", "lines", "units", money.total("line").alias("amount"))
    )


def _empty_filter(tables: Tables) -> DataFrame:
    return dashboard.star(tables, NOTHING).agg(F.count(F.lit(1)).alias("lines"))


def _status_progression(tables: Tables) -> DataFrame:
    orders = mutations.ship_latest(tables.orders)
    orders = mutations.deliver_latest_shipped(orders)
    return mutations.refund_random(orders).select("order_id", "status")


def _refund_propagation(tables: Tables) -> DataFrame:
    orders = mutations.refund_random(tables.orders, status="placed")
    return mutations.refund_payments(tables.payments, orders)


def _next_keys(tables: Tables) -> DataFrame:
    return quality.run_suite(
        numbering.next_key(frame, ENTITIES[name].key).withColumn("table_name", F.lit(name))
        for name, frame in tables.items()
    )


def _not_null(tables: Tables) -> DataFrame:
    return marts.mart_checks({name: marts.MARTS[name](tables) for name in marts.NOT_NULL})


def _unique(tables: Tables) -> DataFrame:
    return quality.run_suite(quality.unique(frame, name, ENTITIES[name].key) for name, frame in tables.items())


def _not_null_tables(tables: Tables) -> DataFrame:
    """Every column of the five tables."""
    return quality.run_suite(
        quality.not_null(frame, name, ENTITIES[name].column_names) for name, frame in tables.items()
    )


def _hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly mart's figures over the events table, which has times of day."""
    events = testdata.events(configure(spark), folder)
    kept = F.col("event_type") != "error"
    return (
        events.groupBy(time.hour_start(F.col("ts")).alias("event_hour"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            *money.sum_parts(F.when(kept, F.col("value")).otherwise(0.0), "kept"),
            F.count(F.when(kept, F.col("value"))).alias("kept_rows"),
        )
        .select(
            "event_hour",
            "events",
            money.total("kept").alias("amount"),
            money.mean("kept", F.col("kept_rows")).alias("avg_amount"),
        )
        .orderBy("event_hour")
    )


def carts(events: DataFrame) -> DataFrame:
    """Two cart lines per purchase event, for products `k` and `k + 1`."""
    number = F.get_json_object("props", "$.k").cast("long")
    bought = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("cart"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_ts"),
        F.explode(F.array(number, number + 1)).alias("product_id"),
    )
    return bought.withColumn("quantity", F.col("product_id") % 2 + 1)


def _order_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """New orders from carts, one row per order with its payment and item ids."""
    tables = testdata.load(configure(spark), folder)
    events = testdata.events(spark, folder)
    orders, items, payments = mutations.new_orders(carts(events), tables)
    held = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.min("order_item_id").alias("first_item"),
        F.max("order_item_id").alias("last_item"),
    )
    return orders.join(held, "order_id").join(payments, "order_id")


def _load_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table_set.row_counts(testdata.load(configure(spark), folder).items())


def _observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the five tables, seen while they are written to storage."""
    root, watched = scratch_path(configure(spark), "tables"), []
    for name, frame in testdata.load(spark, folder).items():
        watched.append(quality.Watched(frame, name))
        watched[-1].frame.write.parquet(f"{root}/{name}")
    return quality.watched_counts(spark, watched)


def _observed_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The marts' checks, seen while the marts are built and written."""
    built = marts.build_marts(testdata.load(configure(spark), folder), scratch_path(spark, "marts"), list(marts.NOT_NULL))
    return quality.watched_checks(spark, built)


def _checked_marts(spark: SparkSession, folder: str) -> DataFrame:
    """The checks on marts that were built, written and read back."""
    path = scratch_path(configure(spark), "marts")
    marts.build_marts(testdata.load(spark, folder), path, list(marts.NOT_NULL))
    return marts.check_marts(spark, path)


def _bucketed_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals against their lines, over tables saved in buckets by order: no shuffle once they are saved."""
    prefix = f"tidemark_{uuid.uuid4().hex}_"
    layouts.save_bucketed(testdata.load(configure(spark), folder), prefix, 16, ["orders", "order_items"])
    saved = layouts.bucketed_tables(spark, prefix)
    return mutations.reconcile_totals(saved.orders, saved.order_items)


def _monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The filtered daily trend over orders stored by month, of which only the selected months are read."""
    tables, path = testdata.load(configure(spark), folder), scratch_path(spark, "orders-by-month")
    layouts.save_by_month(tables.orders, path)
    stored = dict(tables.items()) | {"orders": layouts.orders_between(spark, path, SELECTED.start, SELECTED.end)}
    return dashboard.daily_trend(Tables(**stored), SELECTED)


def _kpi_row_sql(spark: SparkSession, folder: str) -> DataFrame:
    return parametric.kpi_row(spark, testdata.load(configure(spark), folder), SELECTED)


def _read_back(spark: SparkSession, folder: str) -> DataFrame:
    """The orders and payments written as parquet, read with their declared columns and joined."""
    root, tables = scratch_path(configure(spark), "tables"), testdata.load(spark, folder)
    for name in ("orders", "payments"):
        tables.table(name).write.parquet(f"{root}/{name}")
    read = table_set.read_tables(spark, root)
    return read.orders.join(read.payments.select("order_id", "payment_id", "payment_status", "amount"), "order_id")


QUERIES: dict[str, Query] = {
    # Marts
    **{name: _on_tables(plan) for name, plan in marts.MARTS.items()},
    "hourly_events": _hourly_events,
    # Page
    "kpi_row_line_grain": _on_tables(dashboard.kpi_row),
    "kpi_row_order_grain": _on_tables(lambda t: dashboard.kpi_row(t, grain=ORDER)),
    "kpi_row_filtered": _on_tables(lambda t: dashboard.kpi_row(t, SELECTED)),
    "daily_trend": _on_tables(lambda t: dashboard.daily_trend(t, SELECTED)),
    "daily_trend_order_grain": _on_tables(lambda t: dashboard.daily_trend(t, grain=ORDER)),
    "daily_trend_long": _on_tables(dashboard.daily_trend_long),
    "orders_by_status": _on_tables(lambda t: dashboard.orders_by_status(t, SELECTED)),
    "city_filtered": _on_tables(lambda t: dashboard.revenue_by_city(t, SELECTED)),
    "city_order_grain": _on_tables(lambda t: dashboard.revenue_by_city(t, grain=ORDER)),
    "top_products_filtered": _on_tables(lambda t: dashboard.top_products(t, SELECTED)),
    "top_products_first": _on_tables(lambda t: marts.MARTS["top_products"](t).limit(10)),
    "top_products_unfiltered": _on_tables(dashboard.top_products),
    "retention_by_tier": _on_tables(lambda t: dashboard.retention_by_tier(t, SELECTED)),
    "customer_order_window": _on_tables(lambda t: dashboard.orders_with_customer_count(t, SELECTED)),
    "star_join": _on_tables(_star_totals),
    "empty_filter": _on_tables(_empty_filter),
    "kpi_row_empty": _on_tables(lambda t: dashboard.kpi_row(t, NOTHING)),
    "payment_mix": _on_tables(dashboard.payment_mix),
    "payment_share": _on_tables(dashboard.payment_share),
    "filter_options": _on_tables(dashboard.filter_options),
    "date_bounds": _on_tables(dashboard.date_bounds),
    "recent_orders": _on_tables(dashboard.recent_orders),
    "latest_events": _latest_events(30),
    "recent_events": _latest_events(20),
    # Change data
    "cdc_raw_log": _raw_log,
    "cdc_op_counts": _op_counts,
    "cdc_current_state": _state("orders"),
    "cdc_state_customers": _state("customers"),
    "cdc_state_products": _state("products"),
    "cdc_state_order_items": _state("order_items"),
    "cdc_state_payments": _state("payments"),
    "cdc_state_streamed": _streamed_orders,
    "cdc_state_stateful": _stateful_orders,
    "cdc_closed_loop": _closed_loop,
    "cdc_log_deduplicated": _deduplicated_log,
    "kept_marts": _kept_marts,
    "cdc_quarantine": _quarantined,
    "cdc_log_stored": _stored_log,
    "cdc_snapshot_events": _on_tables(_snapshot),
    "cdc_diff_events": _on_tables(_diff),
    "cdc_diff_few": _on_tables(_few_diff),
    "cdc_merge": _on_tables(_merged),
    # Mutations
    "status_progression": _on_tables(_status_progression),
    "refund_propagation": _on_tables(_refund_propagation),
    "tier_upgrade": _on_tables(lambda t: mutations.upgrade_random_customers(t.customers)),
    "price_uplift": _on_tables(lambda t: mutations.uplift_prices(t.products)),
    "payment_derivation": _on_tables(lambda t: t.payments),
    "order_total_reconcile": _on_tables(lambda t: mutations.reconcile_totals(t.orders, t.order_items)),
    "next_keys": _on_tables(_next_keys),
    "new_order_bundle": _order_bundle,
    "sample_k": _on_tables(lambda t: sampling.random_k(t.customers, 10, "customer_id", 42)),
    # Checks
    "dq_not_null": _on_tables(_not_null),
    "dq_not_null_tables": _on_tables(_not_null_tables),
    "dq_unique": _on_tables(_unique),
    "dq_not_null_built": _checked_marts,
    "dq_not_null_observed": _observed_checks,
    "load_counts": _load_counts,
    "load_counts_observed": _observed_counts,
    # Stored layouts and SQL
    "tables_read_back": _read_back,
    "order_total_bucketed": _bucketed_totals,
    "daily_trend_by_month": _monthly_trend,
    "kpi_row_sql_params": _kpi_row_sql,
}
