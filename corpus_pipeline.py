"""The corpus pipeline: stages applied one after another to the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality_rules),
    ("quality_classifier", stages.quality_classifier),
    ("near_duplicates", stages.near_duplicates),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: Trained scores and estimates by Newton steps cannot be put in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written, then read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
