"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: A word: a run of code points other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\v\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Batches sent to Python hold at most this many bytes, whatever the length of the texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(most))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back: a short plan, and rows that do
    not change when a lost executor's work is repeated."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text. Plain replacing and splitting took a fifth of a regular expression's time."""
    for blank in _BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def squeezed(text: Column) -> Column:
    """The text without blanks between or around words."""
    for blank in _BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, though the body names it often, also in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bound(frame: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The kept columns and new ones, which later expressions cannot be merged into."""
    fresh = F.struct(*[c.alias(n) for n, c in columns.items()])
    return frame.select(*keep, F.inline(F.array(fresh)))


def ranked(frame: DataFrame, keys: list[str], order: list[Column], salt: Column, rows_per_part: int, rank: str) -> DataFrame:
    """Adds a gapless rank from 0 within the keys. A key's rows are dealt over parts by a hash of
    `salt`, ranked there, and moved up by the rows of the parts before, so that a key with a third of
    all rows is not sorted by one task. Ranks depend on the rows alone.
    """
    total = frame.count()
    parts = max(1, -(-total // rows_per_part))
    salted = frame.withColumn("_part", F.pmod(salt, F.lit(parts)).cast("int"))
    sizes = salted.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*keys, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    local = salted.withColumn("_within", F.row_number().over(within) - 1)
    return local.join(firsts, [*keys, "_part"]).withColumn(rank, F.col("_first") + F.col("_within")).drop("_part", "_first", "_within")


def streamed_rows(batches) -> Iterator[tuple]:
    """The rows of Arrow batches, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 1, most: int = 1024) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded weight."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*held, strict=True), schema, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)

    held, load = [], 0
    for row in rows:
        held.append(row)
        load += weight(row)
        if load >= most:
            yield batch(held)
            held, load = [], 0
    if held:
        yield batch(held)
