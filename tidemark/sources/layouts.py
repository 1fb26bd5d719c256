"""Stored layouts that spare later work: tables bucketed by a join key, and orders in folders by month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES
from tidemark.sources.tables import Tables

#: The key that joins of a table go by most.
BUCKET_KEYS = {"customers": "customer_id", "orders": "order_id", "order_items": "order_id", "payments": "order_id", "products": "product_id"}
BUCKET_ROWS, LEAST_BUCKETS = 2_000_000, 8
MONTH = "order_month"


def save_bucketed(tables: Tables, prefix: str, buckets: int | None, names: list[str] | None = None, keys: dict[str, str] = BUCKET_KEYS) -> None:
    """Save tables as `<prefix><entity>`, rows of equal join keys in one bucket.

    Joins and sums by the key of tables with equal numbers of buckets then need no shuffle. A bucket is one file, and
    one task reads it: choose their number so that a bucket stays near 256 MB; without a number there is one for every `BUCKET_ROWS` rows
    of the table. Rows are dealt to the files before they are written.
    """
    for name in names or list(BUCKET_KEYS):
        key, frame = keys[name], tables.table(name)
        number = buckets or max(LEAST_BUCKETS, -(-frame.count() // BUCKET_ROWS))
        dealt = frame.repartition(number, key)
        dealt.write.bucketBy(number, key).sortBy(key).mode("overwrite").option("compression", "zstd").saveAsTable(f"{prefix}{name}")


def bucketed_tables(spark: SparkSession, prefix: str) -> Tables:
    return Tables(**{name: (lambda n=name: spark.table(f"{prefix}{n}")) for name in ENTITIES})


def save_by_month(orders: DataFrame, folder: str) -> None:
    """Orders in one folder per month of their time; those without a time in a folder of their own."""
    month = F.trunc(F.to_date("order_ts"), "month")
    # A month's rows go to a few tasks, so that neither many small files nor one large one come of it.
    spread = F.pmod(F.xxhash64("order_id"), F.lit(4))
    orders.withColumn(MONTH, month).repartition(MONTH, spread).write.mode("overwrite").partitionBy(MONTH).parquet(folder)


def _by_month(spark: SparkSession, folder: str) -> DataFrame:
    layout = ENTITIES["orders"].schema.add(MONTH, "date")
    return spark.read.schema(layout).parquet(folder)


def orders_between(spark: SparkSession, folder: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Orders of the months from `start` to `end`; only their folders are read. Days within the months are left to the caller."""
    orders = _by_month(spark, folder)
    if start is not None:
        orders = orders.where(F.col(MONTH) >= F.lit(start.replace(day=1)))
    if end is not None:
        orders = orders.where(F.col(MONTH) <= F.lit(end))
    return orders.select(ENTITIES["orders"].column_names)


def orders_in_months(spark: SparkSession, folder: str, months: DataFrame) -> DataFrame:
    """Orders of the months that a table with a column `order_month` names, read only there: the months are known at run time."""
    return _by_month(spark, folder).join(months.select(MONTH), MONTH, "left_semi").select(ENTITIES["orders"].column_names)
