"""The set of five current tables: loading, registering and checking it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES

Source = DataFrame | Callable[[], DataFrame]


class Tables:
    """The five current tables. One given as a function is read when first used."""

    def __init__(
        self, customers: Source, products: Source, orders: Source, order_items: Source, payments: Source
    ):
        self._sources: dict[str, Source] = {
            "customers": customers,
            "products": products,
            "orders": orders,
            "order_items": order_items,
            "payments": payments,
        }

    def table(self, name: str) -> DataFrame:
        source = self._sources[name]
        if callable(source):
            source = self._sources[name] = source()
        return source

    customers = property(lambda self: self.table("customers"))
    products = property(lambda self: self.table("products"))
    orders = property(lambda self: self.table("orders"))
    order_items = property(lambda self: self.table("order_items"))
    payments = property(lambda self: self.table("payments"))

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self.table(name)) for name in ENTITIES]


def read_tables(spark: SparkSession, folder: str) -> Tables:
    """Parquet tables `<folder>/<entity>` with their declared columns."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(ENTITIES[name].schema).parquet(f"{folder.rstrip('/')}/{name}")

    return Tables(**{name: partial(read, name) for name in ENTITIES})


def catalog_tables(spark: SparkSession) -> Tables:
    """The registered `<entity>_current` tables or views."""
    missing = missing_tables(spark)
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
    return Tables(**{name: partial(spark.table, entity.table) for name, entity in ENTITIES.items()})


def register_views(tables: Tables) -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(ENTITIES[name].table)


def missing_tables(spark: SparkSession, names: Iterable[str] | None = None) -> list[str]:
    wanted = [e.table for e in ENTITIES.values()] if names is None else list(names)
    return [name for name in wanted if not spark.catalog.tableExists(name)]


def show_tables(spark: SparkSession) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables())


def row_counts(frames: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table: `table_name`, `row_count`."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in frames
    ]
    return reduce(DataFrame.unionByName, counts)


def to_pandas(result: DataFrame, max_rows: int) -> pd.DataFrame:
    """A result for display. Refuses, rather than cuts, one that is larger than the caller expects."""
    rows = result.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to storage instead")
    return rows


def read_relational(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], splits: int, **options: str
) -> DataFrame:
    """A database table, read in `splits` key ranges side by side."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=splits, properties=options,
    )


def write_relational(frame: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    """Bulk load; the number of connections is the number of partitions of `frame`."""
    frame.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=options)
