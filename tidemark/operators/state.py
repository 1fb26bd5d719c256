"""Folding changes into one current row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.decode import DELETE, POSITION, UPSERT
from tidemark.operators.shaping import computed_once
from tidemark.schemas import Entity

DELETED, TOPIC, PARTITION, OFFSET, BATCH = "_deleted", "_topic", "_partition", "_offset", "_batch"


def version_schema(entity: Entity) -> T.StructType:
    """A stored row: the entity's columns, whether it is deleted, and the change it comes from."""
    return T.StructType(
        [
            *entity.schema.fields,
            T.StructField(DELETED, T.BooleanType()),
            T.StructField(TOPIC, T.StringType()),
            T.StructField(PARTITION, T.IntegerType()),
            T.StructField(OFFSET, T.LongType()),
        ]
    )


def part_schema(entity: Entity) -> T.StructType:
    """A stored row of an appended part: with the batch it comes from."""
    return T.StructType([*version_schema(entity).fields, T.StructField(BATCH, T.LongType())])


def latest_parts(parts: DataFrame, entity: Entity, columns: list[str] | None = None) -> DataFrame:
    """One row per key out of parts with one row per key and batch: that of the latest batch.

    With `columns`, only the key and these are shuffled; a later select would not spare the others.
    """
    columns = [c for c in columns or part_schema(entity).fieldNames() if c != entity.key]
    folded = parts.groupBy(entity.key).agg(F.max_by(F.struct(*columns), F.col(BATCH)).alias("row"))
    return folded.select(entity.key, "row.*")


def versioned_columns(entity: Entity) -> list[str]:
    return version_schema(entity).fieldNames()


def latest_changes(changes: DataFrame, entity: Entity) -> DataFrame:
    """The last change of every key, deletions kept as marked rows.

    Within a batch, topics count in the order of their names, then partitions, then offsets; a key's
    changes normally share a topic and a partition. max_by combines before the shuffle, so a key with
    very many changes sends one row per task.
    """
    row = F.struct(
        *[c for c in entity.column_names if c != entity.key],
        (F.col("action") == DELETE).alias(DELETED),
        *[F.col(c).alias(name) for c, name in zip(POSITION, (TOPIC, PARTITION, OFFSET))],
    )
    # Rows that do not apply get no position and so never win. A filter in front would be pushed
    # below the decoding and parse every payload twice.
    position = F.when(
        F.col("action").isin(UPSERT, DELETE), F.struct(*POSITION)
    )
    return (
        changes.groupBy(entity.key)
        .agg(F.max_by(row, position).alias("row"))
        .where(F.col("row").isNotNull())
        .select(entity.key, "row.*")
        .select(*versioned_columns(entity))
    )


def every_change(changes: DataFrame, entity: Entity) -> DataFrame:
    """All changes that apply, as `latest_changes` lays them out: the same rows where each key has one change, without a shuffle."""
    applies = F.col("action").isin(UPSERT, DELETE).alias("_applies")
    renamed = [F.col(c).alias(name) for c, name in zip(POSITION, (TOPIC, PARTITION, OFFSET))]
    rows = changes.select(*entity.column_names, (F.col("action") == DELETE).alias(DELETED), *renamed, applies)
    # Computed before the filter, which would otherwise parse every payload once more.
    return computed_once(rows).where("_applies").select(*versioned_columns(entity))


def live_rows(versioned: DataFrame, entity: Entity, columns: list[str] | None = None) -> DataFrame:
    return versioned.where(~F.col(DELETED)).select(*columns or entity.column_names)


def merge_versions(stored: DataFrame, incoming: DataFrame, entity: Entity) -> DataFrame:
    """Stored rows with incoming ones put on top; both hold at most one row per key.

    A later batch wins, whatever its topics and offsets: every message that is processed counts, in the order
    of processing. Redelivered messages are no part of `incoming`: the log leaves them out. Deleted
    keys stay as marked rows.
    """
    layout = versioned_columns(entity)
    numbered = [frame.select(*layout, F.lit(n).cast("long").alias(BATCH)) for n, frame in enumerate((stored, incoming))]
    return latest_parts(numbered[0].unionByName(numbered[1]), entity).select(*layout)


def as_versions(state: DataFrame, entity: Entity) -> DataFrame:
    """Plain rows as stored versions that any change replaces."""
    return state.select(
        *entity.column_names,
        F.lit(False).alias(DELETED),
        F.lit(None).cast("string").alias(TOPIC),
        F.lit(-1).alias(PARTITION),
        F.lit(-1).cast("long").alias(OFFSET),
    )


def apply_changes(state: DataFrame, changes: DataFrame, entity: Entity) -> DataFrame:
    """Current rows after the changes: the batch form of the streamed merge."""
    merged = merge_versions(as_versions(state, entity), latest_changes(changes, entity), entity)
    return live_rows(merged, entity)
