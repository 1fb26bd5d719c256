"""Change messages to log rows, and log rows to typed changes.

A message carries a JSON envelope `{"op", "ts_ms", "before", "after"}`. Two steps read it:

* `route_messages` splits messages into log rows and rows that cannot be logged. A log row may
  still be impossible to apply: the log is written first and is a superset of what is applied.
* `decode_changes` reads one entity's log rows into typed columns and an `action`.

Where the log itself is not wanted, `message_changes` takes both steps with one parse.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, time
from tidemark.operators.shaping import computed_once
from tidemark.schemas import ID, LOG_COLUMNS, MONEY, TEXT, TIME, Entity

UPSERT, DELETE, REJECT, IGNORE = "upsert", "delete", "reject", "ignore"
LOG, QUARANTINE = "log", "quarantine"
#: What identifies a message, and its order within a batch.
POSITION = ("kafka_topic", "kafka_partition", "kafka_offset")

# JSON texts that count as absent, besides zero in any spelling.
_EMPTY_TEXTS = ("null", "false", '""', "[]", "{}")
_ZERO_TEXT = r"^-?0+(\.0*)?([eE].*)?$"


def entity_of(topic: Column) -> Column:
    """The last dotted part of a topic name."""
    return F.element_at(F.split(topic, r"\."), -1)


def route_messages(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per message with a value: `route` says whether it belongs in the log.

    Messages without a value are dropped. A row that cannot be logged (not UTF-8, not JSON, not
    an object, unreadable ts_ms) keeps its raw bytes and a reason. A filter on the topic belongs before
    this step: later ones stay above it. With `columns`, only these are built; a later select would not spare the others.
    """
    routed = _judged(messages).select(*_routed_columns())
    return computed_once(routed.select(*columns) if columns else routed)


def _judged(messages: DataFrame) -> DataFrame:
    """Messages with a value, their parsed documents and why they cannot be logged."""
    judged = messages.where(F.col("value").isNotNull())
    for columns in _judging_steps():
        judged = judged.select(*columns)
    return judged


def of_entity(messages: DataFrame, entity: str) -> DataFrame:
    """The messages of one entity's topics."""
    return messages.where(entity_of(F.col("topic")) == entity)


@cache
def _judging_steps() -> tuple[list[Column], ...]:
    text = F.try_validate_utf8(F.col("value"))
    parsed = [
        entity_of(F.col("topic")).alias("entity"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value"),
        text.alias("payload"),
        F.try_parse_json(text).alias("doc"),
    ]
    head = [F.col("*"), F.try_variant_get("doc", "$", "struct<op:variant,ts_ms:variant>").alias("head")]
    stamp = F.col("head.ts_ms")
    fields = [
        F.col("*"),
        coerce.to_text(F.col("head.op")).alias("op"),
        coerce.to_id(stamp).alias("event_ts_ms"),
    ]
    unreadable = stamp.isNotNull() & ~F.is_variant_null(stamp) & F.col("event_ts_ms").isNull()
    reason = (
        F.when(F.col("payload").isNull(), "invalid utf-8")
        .when(F.col("doc").isNull(), "invalid json")
        .when(F.col("head").isNull(), "not an object")
        .when(unreadable, "unreadable ts_ms")
    )
    return parsed, head, fields, [F.col("*"), reason.alias("reason")]


@cache
def _routed_columns() -> list[Column]:
    return [
        F.when(F.col("reason").isNull(), LOG).otherwise(QUARANTINE).alias("route"),
        *[F.col(c) for c in LOG_COLUMNS if c != "processed_at"],
        F.col("reason"),
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("raw_value"),
        time.now().alias("processed_at"),
    ]


def log_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == LOG).select(*LOG_COLUMNS)


def unloggable_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == QUARANTINE).select(
        "entity", "kafka_topic", "kafka_partition", "kafka_offset", "reason", "raw_value"
    )


def _image(name: str, columns: list[str]) -> Column:
    """All wanted fields of an envelope image in one pass; NULL when it is not an object."""
    layout = ",".join(f"{column}:variant" for column in columns)
    return F.try_variant_get("doc", f"$.{name}", f"struct<{layout}>")


def _is_filled(name: str, columns: list[str]) -> Column:
    """Whether an image counts as present: any non-empty, non-zero value does."""
    known = [F.col(f"{name}.{column}").isNotNull() for column in columns]
    any_known = known[0]
    for test in known[1:]:
        any_known = any_known | test
    text = F.to_json(F.try_variant_get("doc", f"$.{name}", "variant"))
    other = ~text.isin(*_EMPTY_TEXTS) & ~text.rlike(_ZERO_TEXT)
    return F.when(any_known, F.lit(True)).otherwise(F.coalesce(other, F.lit(False)))


_READERS = {
    TEXT: coerce.to_text,
    MONEY: coerce.to_amount,
}


def decode_changes(log: DataFrame, entity: Entity, id_bits: int = 64) -> DataFrame:
    """Typed changes of one entity: its columns, `action`, `op` and the position.

    * op "d" with a filled `before` deletes the key found there; anything else with a filled
      `after` upserts the whole row, absent fields becoming NULL; the rest is ignored.
    * A change whose required ids cannot be read is rejected, so an earlier good one still counts.

    `id_bits=32` additionally rejects ids outside the 32-bit range.
    """
    parsed = log.select("op", *POSITION, F.try_parse_json("payload").alias("doc"))
    return _decoded(parsed, entity, id_bits)


def message_changes(messages: DataFrame, entity: Entity, id_bits: int = 64) -> DataFrame:
    """The changes of one entity's messages as `decode_changes` gives them for their log rows, each payload parsed once.

    No filter takes out messages that cannot be logged, as it would parse again below the projection; they are ignored changes.
    """
    judged = _judged(of_entity(messages, entity.name))
    logged = F.when(F.col("reason").isNull(), F.col("doc"))
    return _decoded(judged.select("op", *POSITION, logged.alias("doc")), entity, id_bits)


def _decoded(parsed: DataFrame, entity: Entity, id_bits: int) -> DataFrame:
    for columns in _decode_steps(entity, id_bits):
        parsed = parsed.select(*columns)
    return parsed


@cache
def _decode_steps(entity: Entity, id_bits: int) -> tuple[list[Column], ...]:
    """The columns of the successive selects.

    Kept between calls: putting the expressions together takes longer than planning them, and a
    stream needs the same ones for every micro-batch.
    """
    columns = entity.column_names
    defaults = dict(entity.defaults)
    position = [F.col(c) for c in POSITION]
    is_delete = F.coalesce(F.col("op"), F.lit("")) == "d"
    images = [
        F.col("*"),
        # The earlier image only matters for deletions.
        F.when(is_delete, _image("before", [entity.key])).alias("before"),
        _image("after", columns).alias("after"),
    ]

    def read(kind: str, name: str) -> list[Column]:
        field = F.col(f"after.{name}")
        if kind == TIME:
            return [
                coerce.json_text(field).alias(f"{name}__text"),
                coerce.whole_number(field).alias(f"{name}__number"),
            ]
        if kind != ID:
            return [_READERS[kind](field).alias(name)]
        value = coerce.to_id(field, id_bits)
        if name in defaults:
            value = F.when(field.isNull(), F.lit(defaults[name]).cast("long")).otherwise(value)
        return [value.alias(name)]

    deletes = is_delete & _is_filled("before", [entity.key])
    times = {
        name: coerce.to_time(F.col(f"{name}__text"), F.col(f"{name}__number"))
        for name, kind in entity.columns
        if kind == TIME
    }
    typed = [
        F.col("op"),
        *position,
        deletes.alias("deletes"),
        _is_filled("after", columns).alias("upserts"),
        coerce.to_id(F.col(f"before.{entity.key}"), id_bits).alias("before_key"),
        *[column for name, kind in entity.columns for column in read(kind, name)],
    ]
    readable = F.lit(True)
    for name in entity.required:
        readable = readable & F.col(name).isNotNull()
    action = (
        F.when(F.col("deletes"), F.when(F.col("before_key").isNotNull(), DELETE).otherwise(REJECT))
        .when(F.col("upserts"), F.when(readable, UPSERT).otherwise(REJECT))
        .otherwise(IGNORE)
    )
    key = F.when(F.col("deletes"), F.col("before_key")).otherwise(F.col(entity.key))
    changes = [
        action.alias("action"),
        F.col("op"),
        key.alias(entity.key),
        *[
            F.when(~F.col("deletes"), times.get(c, F.col(c))).alias(c)
            for c in columns
            if c != entity.key
        ],
        *position,
    ]
    return images, typed, changes


def rejected_rows(log: DataFrame, entity: Entity, id_bits: int = 64) -> DataFrame:
    """Positions of logged changes of one entity that could not be applied."""
    changes = decode_changes(log.where(F.col("entity") == entity.name), entity, id_bits)
    return changes.where(F.col("action") == REJECT).select(
        F.lit(entity.name).alias("entity"), *POSITION,
        F.lit("missing or unreadable key").alias("reason"),
    )
