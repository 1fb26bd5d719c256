"""Change log and current tables on plain parquet, grown batch by batch.

Layout below the root:

    log/batch=<n>/route=<log|quarantine>/entity=<e>/   one batch of messages, in one write
    parts/<table>/<n>/                                 what batch n changed, one row per key
    parts/<table>/<n>-whole/                           the whole table after batch n
    commits/<n>.json                                   which parts make up each table

A batch appends the last change of each key it touches; readers put the parts of a table together, the latest
change of a key counting. When the appended rows outgrow the table, or there are many parts, the batch also writes
the table as a whole, without deleted keys. So a batch costs what it changes, and a rewrite what was appended since the last.

A batch becomes visible when its commit file appears, after the log and all parts are written; a
batch that failed half-way is written again to the same folders. A commit also holds the last
batch of each stream, so a batch delivered again is skipped. A message delivered again in another
batch, which means equal topic, partition and offset, is left out of the log and so of the tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import decode, state
from tidemark.plans import dashboard
from tidemark.schemas import ENTITIES, LOG_COLUMNS, LOG_SCHEMA, Entity
from tidemark.sources.files import Folder
from tidemark.sources.tables import Tables
from tidemark.streaming import keeping

#: Parts after which a table is written as a whole, however small they are.
MOST_PARTS = 24
#: Payloads repeat their field names; this takes half the space of the default.
CODEC = "zstd"
_RECENT_BATCHES = 64

_ROUTED_SCHEMA = T.StructType(
    [
        *[f for f in LOG_SCHEMA.fields],
        T.StructField("reason", T.StringType()),
        T.StructField("raw_value", T.BinaryType()),
        T.StructField("batch", T.LongType()),
        T.StructField("route", T.StringType()),
    ]
)


@dataclass
class Commit:
    """What is current after a batch. Its size is bounded by tables x parts and by partitions."""

    number: int = -1
    # table -> its parts, oldest first: folder name and rows
    parts: dict[str, list[list]] = field(default_factory=dict)
    # stream id -> its last batch id
    streams: dict[str, int] = field(default_factory=dict)
    # topic -> partition -> lowest and highest offset in the log
    offsets: dict[str, dict[str, list[int]]] = field(default_factory=dict)
    # newest batches and their log row counts, oldest first
    recent: list[tuple[int, int]] = field(default_factory=list)


def outgrown(parts: list[list]) -> bool:
    """Whether the rows appended to a table outnumber those of its first part, or there are many parts."""
    return len(parts) > MOST_PARTS or sum(rows for _, rows in parts[1:]) > parts[0][1] if parts else False


class ChangeStore:
    """A root folder with one writer at a time; any number of readers.

    The log holds each message once. A topic that is made anew and counts from 0 again needs a new
    name, as its messages would be taken for the old ones.
    """

    def __init__(self, spark: SparkSession, root: str, keep_marts: bool = False):
        """With `keep_marts`, batches also bring the marts of `plans.kept` up to date."""
        self.spark = spark
        self.folder = Folder(spark, root)
        self.keep_marts = keep_marts

    # Commits

    def commit_numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names("commits") if n.endswith(".json")]

    def commit(self) -> Commit:
        numbers = self.commit_numbers()
        if not numbers:
            return Commit()
        return self._read_commit(max(numbers))

    def _read_commit(self, number: int) -> Commit:
        return Commit(**json.loads(self.folder.read_text("commits", f"{number:012d}.json")))

    # Reading

    def current(self, name: str, columns: list[str] | None = None) -> DataFrame:
        """Current rows of an entity, or some of their columns; an empty table before its first change."""
        return self._current(self.commit(), ENTITIES[name], columns=columns)

    def tables(self) -> Tables:
        return Tables(**{name: self.current(name) for name in ENTITIES})

    def register_views(self) -> None:
        """Register `<entity>_current` for all entities, and `raw_cdc_events`."""
        for name, entity in ENTITIES.items():
            self.current(name).createOrReplaceTempView(entity.table)
        self.log().createOrReplaceTempView("raw_cdc_events")

    def kept_mart(self, name: str) -> DataFrame:
        """A mart as the batches have kept it."""
        return keeping.kept_mart(self, self.commit(), name)

    def _current(self, commit: Commit, entity: Entity, only: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
        """Current rows, if wanted only those whose keys are in `only`, or some of their columns."""
        parts = commit.parts.get(entity.name, [])
        stored = self.read_parts(entity.name, parts, state.part_schema(entity))
        if only is not None:
            stored = stored.join(only.select(entity.key), entity.key, "left_semi")
        if len(parts) > 1:
            stored = state.latest_parts(stored, entity, columns and [*columns, state.DELETED])
        return state.live_rows(stored, entity, columns)

    def read_parts(self, table: str, parts: list[list], layout: T.StructType) -> DataFrame:
        paths = [self.folder.path("parts", table, part) for part, _ in parts]
        if not paths:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(*paths)

    def _routed(self, commit: Commit) -> DataFrame:
        if not self.folder.exists("log"):
            return self.spark.createDataFrame([], _ROUTED_SCHEMA)
        rows = self.spark.read.schema(_ROUTED_SCHEMA).parquet(self.folder.path("log"))
        # Folders of a batch that has not been committed are not part of the log.
        return rows.where(F.col("batch") <= commit.number)

    def log(self) -> DataFrame:
        return self._routed(self.commit()).where(F.col("route") == decode.LOG).select(*LOG_COLUMNS)

    def quarantine(self) -> DataFrame:
        """Messages that could not be logged, and logged changes that could not be applied."""
        routed = self._routed(self.commit())
        found = decode.unloggable_rows(routed).drop("raw_value")
        for entity in ENTITIES.values():
            found = found.unionByName(decode.rejected_rows(decode.log_rows(routed), entity))
        return found

    def latest_events(self, k: int = 30) -> DataFrame:
        """The newest k log rows, a later batch being newer whatever its clock said.

        That order lets the newest batches that hold k rows stand for the whole log; their folders are
        read by name. With fewer rows in the noted batches the whole log is read, to the same result.
        """
        commit = self.commit()
        wanted, rows = [], 0
        for number, count in reversed(commit.recent):
            wanted.append(number)
            rows += count
            if rows >= k:
                break
        if rows >= k:
            base = self.folder.path("log")
            paths = [self.folder.path("log", f"batch={n}") for n in wanted]
            routed = self.spark.read.schema(_ROUTED_SCHEMA).option("basePath", base).parquet(*paths)
        else:
            routed = self._routed(commit)
        log = routed.where(F.col("route") == decode.LOG)
        return dashboard.latest_events(log.select(*LOG_COLUMNS, "batch"), k, newest_first=["batch"])

    # Writing

    def apply_batch(self, messages: DataFrame, batch_id: int, stream: str = "batch", unique: bool = False, once_per_key: bool = False) -> bool:
        """Log and apply one batch; False if this stream's batch was committed before.

        `unique` promises that no message is in the batch twice, which then is not looked into. `once_per_key` expects one change of
        a key in the batch, as captures give: changes are written as they come, and only their keys are shuffled to see whether it holds.
        """
        commit = self.commit()
        if commit.streams.get(stream, -1) >= batch_id:
            return False
        number = commit.number + 1
        self._write_log(decode.route_messages(messages), "log", f"batch={number}")
        batch = self._read_log("log", f"batch={number}")
        marks = self._marks(batch)
        if self._holds_repeats(batch, marks, commit, unique):
            self._drop_repeats(batch, marks, commit, number)
            batch = self._read_log("log", f"batch={number}")
            marks = self._marks(batch)
        logged = self._note(marks, commit)
        present = set(self.folder.names("log", f"batch={number}", f"route={decode.LOG}"))
        changed = [e for e in ENTITIES.values() if f"entity={e.name}" in present]
        after = Commit(number, {name: list(parts) for name, parts in commit.parts.items()})
        append = partial(self._append, once_per_key=True) if once_per_key else self._append
        self.side_by_side(lambda e: append(batch, after, e), changed)
        if self.keep_marts:
            keeping.keep_marts(self, commit, after)
            keeping.rewrite(self, after, outgrown)
        self.side_by_side(lambda e: self._rewrite(after, e), changed)
        commit.number, commit.parts = number, after.parts
        commit.streams[stream] = batch_id
        commit.recent = [*commit.recent, (number, logged)][-_RECENT_BATCHES:]
        self.folder.publish_text(json.dumps(asdict(commit)), "commits", f"{number:012d}.json")
        return True

    def side_by_side(self, step: Callable, tables: Sequence) -> None:
        """The tables are independent of each other, and so are their jobs."""
        with ThreadPoolExecutor(max_workers=len(ENTITIES)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(step), tables))

    def write_part(self, frame: DataFrame, commit: Commit, table: str, part: str) -> None:
        """Write a part and note it in the commit if it has rows, which are counted while they are written."""
        counted = Observation()
        frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", CODEC).parquet(self.folder.path("parts", table, part))
        rows = counted.get.get("rows", 0)
        if rows:
            commit.parts.setdefault(table, []).append([part, rows])

    def _append(self, batch: DataFrame, commit: Commit, entity: Entity, once_per_key: bool = False) -> None:
        """Write what a logged batch changes in an entity's table."""
        log = batch.where((F.col("route") == decode.LOG) & (F.col("entity") == entity.name))
        changes, number = decode.decode_changes(log, entity), F.lit(commit.number).cast("long")
        part = str(commit.number)
        if once_per_key:
            self.write_part(state.every_change(changes, entity).withColumn(state.BATCH, number), commit, entity.name, part)
            written = self.spark.read.schema(state.part_schema(entity)).parquet(self.folder.path("parts", entity.name, part))
            if written.groupBy(entity.key).count().where("count > 1").isEmpty():
                return
            commit.parts[entity.name].pop()
            part = f"{part}-folded"
        self.write_part(state.latest_changes(changes, entity).withColumn(state.BATCH, number), commit, entity.name, part)

    def _rewrite(self, commit: Commit, entity: Entity) -> None:
        """Write a table as a whole, without its deleted keys, once that pays."""
        parts = commit.parts.get(entity.name, [])
        if outgrown(parts):
            stored = state.latest_parts(self.read_parts(entity.name, parts, state.part_schema(entity)), entity)
            commit.parts[entity.name] = []
            self.write_part(stored.where(~F.col(state.DELETED)), commit, entity.name, f"{commit.number}-whole")

    def _write_log(self, routed: DataFrame, *parts: str) -> None:
        """One pass over the batch, no shuffle: a broker partition belongs to one entity already."""
        routed.write.mode("overwrite").option("compression", CODEC).partitionBy("route", "entity").parquet(self.folder.path(*parts))

    def _read_log(self, *parts: str) -> DataFrame:
        base = self.folder.path(parts[0])
        return self.spark.read.schema(_ROUTED_SCHEMA).option("basePath", base).parquet(self.folder.path(*parts))

    def _marks(self, batch: DataFrame) -> list[Row]:
        """Lowest and highest offset and number of log rows per topic partition."""
        return (
            batch.groupBy("kafka_topic", "kafka_partition")
            .agg(
                F.min("kafka_offset").alias("low"),
                F.max("kafka_offset").alias("high"),
                F.count(F.when(F.col("route") == decode.LOG, F.lit(1))).alias("logged"),
            )
            .collect()
        )

    def _known_range(self, mark: Row, commit: Commit) -> list[int] | None:
        """The logged offsets' range of a topic partition, if the batch reaches into it."""
        known = commit.offsets.get(mark["kafka_topic"], {}).get(str(mark["kafka_partition"]))
        return known if known and mark["low"] <= known[1] and mark["high"] >= known[0] else None

    def _holds_repeats(self, batch: DataFrame, marks: list[Row], commit: Commit, unique: bool) -> bool:
        """Whether the batch may hold messages twice or messages that the log has."""
        if any(self._known_range(mark, commit) for mark in marks):
            return True
        return not unique and not batch.groupBy(*decode.POSITION).count().where("count > 1").isEmpty()

    def _drop_repeats(self, batch: DataFrame, marks: list[Row], commit: Commit, number: int) -> None:
        """Write the batch anew with each message once and none that an earlier batch logged.

        Only topic partitions and offsets that the batch shares with the log are looked up in it.
        """
        fresh = batch.dropDuplicates(list(decode.POSITION))
        shared = F.lit(False)
        for mark in marks:
            if self._known_range(mark, commit):
                shared = shared | (
                    F.col("kafka_topic").eqNullSafe(mark["kafka_topic"])
                    & F.col("kafka_partition").eqNullSafe(mark["kafka_partition"])
                    & F.col("kafka_offset").between(mark["low"], mark["high"])
                )
        earlier = self._routed(commit).where(shared).select(*decode.POSITION)
        fresh = fresh.join(earlier, list(decode.POSITION), "left_anti")
        self._write_log(fresh.select(*batch.columns).drop("batch"), "repeats", f"batch={number}")
        self.folder.delete("log", f"batch={number}")
        self.folder.move(("repeats", f"batch={number}"), ("log", f"batch={number}"))

    def _note(self, marks: list[Row], commit: Commit) -> int:
        """Widen the known offset ranges; gives the number of log rows."""
        for mark in marks:
            parts = commit.offsets.setdefault(mark["kafka_topic"], {})
            key = str(mark["kafka_partition"])
            low, high = parts.get(key, [mark["low"], mark["high"]])
            parts[key] = [min(low, mark["low"]), max(high, mark["high"])]
        return sum(mark["logged"] for mark in marks)

    def vacuum(self, keep: int = 10) -> int:
        """Delete parts that none of the newest `keep` commits uses; the log stays."""
        numbers = sorted(self.commit_numbers())
        kept_numbers, dropped = numbers[-keep:], numbers[:-keep]
        used = {(table, part) for commit in map(self._read_commit, kept_numbers) for table, parts in commit.parts.items() for part, _ in parts}
        deleted = 0
        for table in self.folder.names("parts"):
            for part in self.folder.names("parts", table):
                # Parts of a batch that is being written are newer than all commits.
                if kept_numbers and int(part.split("-")[0]) <= kept_numbers[-1] and (table, part) not in used:
                    self.folder.delete("parts", table, part)
                    deleted += 1
        for number in dropped:
            self.folder.delete("commits", f"{number:012d}.json")
        return deleted
