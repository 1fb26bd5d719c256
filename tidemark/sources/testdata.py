"""The five domain tables and a change stream, derived from the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import time
from tidemark.operators.mutations import payments_from_orders
from tidemark.operators.shaping import computed_once
from tidemark.sources.tables import Tables

TOPIC_PREFIX = "shop.public"
PARTITIONS = 4

# The entity of a user's events is position `user_id % 5`.
EVENT_ENTITIES = ("customers", "products", "orders", "order_items", "payments")
# Change operation per event type, every other type being an update.
EVENT_OPS = {"signup": "c", "error": "d"}


# The columns of the test tables in use. Declared, so that no file is opened before
# the query runs.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, as a streamed path must not name a single file.
    return spark.readStream.schema(SCHEMAS["events"]).parquet(f"{folder}/event[s].parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        _table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("city"),
            F.lit(None).cast("timestamp_ntz").alias("signup_ts"),
            F.col("c_mktsegment").alias("loyalty_tier"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "canceled")
        .when(F.col("o_orderstatus") == "P", "refunded")
        .when(F.col("o_orderstatus") == "O", "placed")
    )
    return _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        status.alias("status"),
        F.col("o_totalprice").alias("total_amount"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines under keys of their own: the order's number, the line's, and its place among lines that have the same of both.

    Queries that do not use the key do without the sorting.
    """
    lines = _table(spark, folder, "lineitem")
    place = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_quantity", "l_extendedprice"))
    return lines.select(
        ((F.col("l_orderkey") * 100 + F.col("l_linenumber")) * 1000 + place).cast("long").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("line_amount"),
    )


def load(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        customers=lambda: customers(spark, folder),
        products=lambda: products(spark, folder),
        orders=lambda: orders(spark, folder),
        order_items=lambda: order_items(spark, folder),
        payments=lambda: payments_from_orders(orders(spark, folder)),
    )


def change_messages(events: DataFrame) -> DataFrame:
    """Broker messages for the events table: one message per event, keyed by user.

    A user's events all concern one row of one entity. Field spellings vary on purpose (epoch
    seconds, millis, micros, ISO text, amounts as text) so that decoding is exercised.
    """
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    amount, ts = F.col("value"), F.col("ts")
    number = F.get_json_object("props", "$.k").cast("long")
    op = F.lit("u")
    for event_type, code in EVENT_OPS.items():
        op = F.when(kind == event_type, code).otherwise(op)
    after = {
        "customers": F.struct(
            user.alias("customer_id"),
            F.concat(F.lit("user "), user).alias("customer_name"),
            F.concat(F.lit("city "), number % 8).alias("city"),
            time.to_micros(ts).alias("signup_ts"),
            kind.alias("loyalty_tier"),
        ),
        "products": F.struct(
            user.cast("string").alias("product_id"),
            F.concat(F.lit("item "), user).alias("product_name"),
            kind.alias("category"),
            amount.alias("unit_price"),
        ),
        "orders": F.struct(
            user.alias("order_id"),
            number.alias("customer_id"),
            F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")).alias("order_ts"),
            kind.alias("status"),
            amount.alias("total_amount"),
        ),
        "order_items": F.struct(
            user.alias("order_item_id"),
            event.alias("order_id"),
            number.alias("product_id"),
            (number % 3 + 1).alias("quantity"),
            amount.alias("unit_price"),
            F.round(amount * (number % 3 + 1), 2).alias("line_amount"),
        ),
        "payments": F.struct(
            user.alias("payment_id"),
            event.alias("order_id"),
            time.to_millis(ts).alias("payment_ts"),
            kind.alias("payment_status"),
            amount.cast("string").alias("amount"),
        ),
    }
    slot = user % len(EVENT_ENTITIES)
    messages = events.withColumn("op", op).select(
        F.concat(F.lit(TOPIC_PREFIX + "."), _pick(slot, [F.lit(e) for e in EVENT_ENTITIES])).alias("topic"),
        (user % PARTITIONS).cast("int").alias("partition"),
        event.alias("offset"),
        _pick(slot, [_envelope(after[e]) for e in EVENT_ENTITIES]).cast("binary").alias("value"),
    )
    return computed_once(messages)


def _pick(slot: Column, choices: list[Column]) -> Column:
    picked = F.when(slot == 0, choices[0])
    for position, choice in enumerate(choices[1:], start=1):
        picked = picked.when(slot == position, choice)
    return picked


def _envelope(after: Column) -> Column:
    image = F.struct(
        F.col("op"),
        time.to_millis(F.col("ts")).alias("ts_ms"),
        F.when(F.col("op") != "c", after).alias("before"),
        F.when(F.col("op") != "d", after).alias("after"),
    )
    return F.to_json(image, {"ignoreNullFields": "false"})


def flawed_messages(events: DataFrame) -> DataFrame:
    """The events' messages, of every 50 one a tombstone, one broken JSON, one broken UTF-8, one
    without a key, and one delivered twice."""
    case = F.col("offset") % 50
    value = (
        F.when(case == 1, F.lit(None))
        .when(case == 2, F.lit("{bad").cast("binary"))
        .when(case == 3, F.lit(b"\xff\xfe"))
        .when(case == 4, F.lit('{"op":"u","ts_ms":1,"after":{"note":"no key"}}').cast("binary"))
        .otherwise(F.col("value"))
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(case == 5, 2).otherwise(1)))
    flawed = change_messages(events).select("topic", "partition", "offset", value.alias("value"), copies.alias("_copy"))
    return flawed.drop("_copy")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return change_messages(events(spark, folder))
