"""Change messages from tables: a first snapshot, or the difference of two versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import time
from tidemark.schemas import TIME, Entity

SNAPSHOT, CREATE, UPDATE, REMOVE = "r", "c", "u", "d"


def _image(entity: Entity, side: str) -> Column:
    """A row as envelope image: timestamps as epoch microseconds, the rest as they are."""
    return F.struct(
        *[
            (time.to_micros(F.col(f"{side}.{name}")) if kind == TIME else F.col(f"{side}.{name}")).alias(name)
            for name, kind in entity.columns
        ]
    )


# Bits of an offset: the capture's number, then the task, then the row in the task.
_TASK_BITS, _ROW_BITS, _ID_ROW_BITS = 17, 30, 33


def _offset(capture: int) -> Column:
    """Offsets above those of every capture with a smaller number."""
    if not 0 <= capture < 1 << 16:
        raise ValueError("captures are numbered from 0 to 65535")
    number = F.monotonically_increasing_id()
    task, row = F.shiftright(number, _ID_ROW_BITS), number.bitwiseAND(F.lit((1 << _ID_ROW_BITS) - 1))
    fits = (task < 1 << _TASK_BITS) & (row < 1 << _ROW_BITS)
    placed = F.lit(capture << (_TASK_BITS + _ROW_BITS)) + F.shiftleft(task, _ROW_BITS) + row
    return F.when(fits, placed).otherwise(F.raise_error(F.lit("too many tasks or rows per task in one capture")).cast("long"))


def _messages(
    pairs: DataFrame, entity: Entity, op: Column, prefix: str, ts_ms: int | None, partitions: int, capture: int
) -> DataFrame:
    """Messages for rows with structs `before` and `after`, partitioned by key.

    Offsets rise within a partition but have gaps; one call gives each key at most one message. Each
    capture of a topic needs a number of its own, greater than those before: messages with equal
    topic, partition and offset are the same message delivered again.
    """
    before, after = F.col("before").isNotNull(), F.col("after").isNotNull()
    stamp = time.to_millis(time.now()) if ts_ms is None else F.lit(ts_ms)
    envelope = F.struct(
        op.alias("op"),
        stamp.alias("ts_ms"),
        F.when(before, _image(entity, "before")).alias("before"),
        F.when(after, _image(entity, "after")).alias("after"),
    )
    key = F.coalesce(F.col(f"after.{entity.key}"), F.col(f"before.{entity.key}"))
    return pairs.select(
        F.lit(f"{prefix}.{entity.name}").alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"),
        _offset(capture).alias("offset"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


def snapshot_events(
    table: DataFrame, entity: Entity, prefix: str, ts_ms: int | None = None, partitions: int = 16, capture: int = 0
) -> DataFrame:
    """Every row as an op "r" message: capture number 0, unless others came before."""
    rows = F.struct(*entity.column_names)
    layout = entity.schema
    pairs = table.select(F.lit(None).cast(layout).alias("before"), rows.alias("after"))
    return _messages(pairs, entity, F.lit(SNAPSHOT), prefix, ts_ms, partitions, capture)


def table_changes(old: DataFrame, new: DataFrame, entity: Entity) -> DataFrame:
    """Rows that differ: `op` with structs `before` and `after`. One shuffle of both sides by key."""
    row = F.struct(*entity.column_names)
    left = old.select(F.col(entity.key).alias("_old_key"), row.alias("before"))
    right = new.select(F.col(entity.key).alias("_new_key"), row.alias("after"))
    op = (
        F.when(F.col("before").isNull(), CREATE)
        .when(F.col("after").isNull(), REMOVE)
        .otherwise(UPDATE)
    )
    # Rows without a key match nothing; in the join they would all meet in one task.
    kept = ["before", "after"]
    layout = entity.schema
    paired = left.where("_old_key IS NOT NULL").join(right.where("_new_key IS NOT NULL"), F.col("_old_key") == F.col("_new_key"), "full").select(*kept)
    loose = left.where("_old_key IS NULL").select("before", F.lit(None).cast(layout).alias("after")).union(
        right.where("_new_key IS NULL").select(F.lit(None).cast(layout).alias("before"), "after")
    )
    return paired.union(loose).where(~F.col("before").eqNullSafe(F.col("after"))).select(op.alias("op"), *kept)


def _digest(entity: Entity) -> Column:
    """96 bits over all columns; a changed row keeps them with a chance of 2^-96."""
    return F.struct(F.xxhash64(*entity.column_names).alias("long"), F.hash(*entity.column_names).alias("short"))


def differing(old: DataFrame, new: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """Both versions without rows that have the same digest under the same key in the other.

    Only keys and digests are shuffled to find them; the keys that differ then pick their rows, on the spot if they are few.
    Rows without a key stay.
    """
    keyed = F.col(entity.key).isNotNull()
    left, right = (v.where(keyed).select(F.col(entity.key).alias("_key"), _digest(entity).alias(d)) for v, d in ((old, "_old"), (new, "_new")))
    keys = left.join(right, "_key", "full").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(F.col("_key").alias("_changed"))
    return tuple(v.join(keys, F.col(entity.key) == F.col("_changed"), "left_semi").union(v.where(~keyed)) for v in (old, new))


def diff_events(
    old: DataFrame, new: DataFrame, entity: Entity, prefix: str, ts_ms: int | None = None, partitions: int = 16,
    *, capture: int, few: bool = False,
) -> DataFrame:
    """Create, update and delete messages that lead from one version of a table to another.

    `capture` is the number of this difference among the captures of the topic, the snapshot being 0. With `few`, for
    versions that differ in few rows, digests are compared first and whole rows fetched for keys that differ only; where most
    rows differ, pairing them at once takes half the time.
    """
    if few:
        old, new = differing(old.select(entity.column_names), new.select(entity.column_names), entity)
    changes = table_changes(old, new, entity)
    return _messages(changes, entity, F.col("op"), prefix, ts_ms, partitions, capture)
