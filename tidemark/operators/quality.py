"""Data checks: one row per check with its failure count."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    pass


def not_null(table: DataFrame, name: str, columns: Iterable[str]) -> DataFrame:
    """Nulls per column, all columns counted in one pass."""
    columns = list(columns)
    counts = table.agg(
        *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f"not_null_{name}_{c}").alias("check_name"),
                F.col(f"n{i}").alias("failures"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return _verdict(counts.select(F.inline(rows)))


def unique(table: DataFrame, name: str, key: str) -> DataFrame:
    """Keys held by more than one row."""
    repeated = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counted = repeated.agg(F.count(F.when(F.col("n") > 1, F.lit(1))).alias("failures"))
    return _verdict(counted.select(F.lit(f"unique_{name}_{key}").alias("check_name"), "failures"))


class Watched:
    """A frame whose rows, and nulls in some columns, are counted while it is written or otherwise run: no second scan."""

    def __init__(self, frame: DataFrame, name: str, columns: Iterable[str] = ()):
        self.name, self.columns, self._seen = name, list(columns), Observation()
        nulls = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"n{i}") for i, c in enumerate(self.columns)]
        self.frame = frame.observe(self._seen, F.count(F.lit(1)).alias("row_count"), *nulls)

    @property
    def row_count(self) -> int:
        """Rows seen; waits for the first run of the frame."""
        return self._seen.get.get("row_count", 0)

    def checks(self) -> list[tuple[str, int]]:
        """Check names and failures as `not_null` gives them."""
        seen = self._seen.get
        return [(f"not_null_{self.name}_{c}", seen.get(f"n{i}", 0)) for i, c in enumerate(self.columns)]


def watched_checks(spark: SparkSession, watched: Iterable[Watched]) -> DataFrame:
    """The results of frames that have run, as `not_null` gives them."""
    rows = [row for w in watched for row in w.checks()]
    return _verdict(spark.createDataFrame(rows, "check_name string, failures long"))


def watched_counts(spark: SparkSession, watched: Iterable[Watched]) -> DataFrame:
    return spark.createDataFrame([(w.name, w.row_count) for w in watched], "table_name string, row_count long")


def _verdict(counts: DataFrame) -> DataFrame:
    failed = F.col("failures") != 0
    return counts.select(
        "check_name", "failures", failed.alias("should_warn"), failed.alias("should_error")
    )


def run_suite(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require_passed(results: DataFrame) -> None:
    """Raise with the failed checks. Results hold one row per declared check."""
    failed = results.where("should_error").collect()
    if failed:
        raise CheckFailed(", ".join(f"{r['check_name']}: {r['failures']}" for r in failed))
