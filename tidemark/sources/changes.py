"""Change streams as DataFrames with columns topic, partition, offset, value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES, MESSAGE_SCHEMA

MESSAGE_COLUMNS = MESSAGE_SCHEMA.fieldNames()


def topics(prefix: str, entities: Iterable[str] = tuple(ENTITIES)) -> list[str]:
    return [f"{prefix}.{name}" for name in entities]


def kafka_stream(
    spark: SparkSession, servers: str, names: Iterable[str], max_offsets: int | None = None, **options: str
) -> DataFrame:
    """Subscribe from the earliest offset; progress is kept in the query's checkpoint.

    Needs Spark's Kafka package on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(names))
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(*MESSAGE_COLUMNS)


def file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages landed as parquet files, for example by a connector's file sink."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def only_topics(messages: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep an include list of topics."""
    return messages.where(F.col("topic").isin(list(names)))
