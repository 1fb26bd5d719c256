"""Current rows and each message once, held in the state of a streaming query.

The engine keeps the state by key in RocksDB on the executors, saves its changes with every batch in the query's
checkpoint, and restores it from there: a batch costs what it brings, whatever the state's size. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import decode, state
from tidemark.schemas import Entity

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def use_rocksdb(spark: SparkSession) -> None:
    """State on the executors' disks, saved as changes; whatever the cluster has set stays."""
    for name, value in ((_PROVIDER, _ROCKSDB), (_CHANGELOG, "true")):
        if not spark.sparkContext.getConf().contains(name):
            spark.conf.set(name, value)


def each_message_once(messages: DataFrame, delay: str | None = None, arrived: str | None = None) -> DataFrame:
    """The messages without those whose topic, partition and offset came before, in this batch or any earlier one.

    The state holds every position. With `delay` and the column `arrived`, positions older than the delay are forgotten, for sources
    that repeat messages only so much later.
    """
    position = ["topic", "partition", "offset"]
    if delay is None:
        return messages.dropDuplicates(position)
    return messages.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(position)


def current_rows(messages: DataFrame, entity: Entity) -> DataFrame:
    """A stream of current rows by key, deleted ones marked: after each batch the rows of the keys it changed.

    Within a key, the highest position counts, so messages that come late or twice change nothing.
    """
    return state.latest_changes(decode.message_changes(messages, entity), entity)


def start_state(messages: DataFrame, entity: Entity, folder: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep an entity's rows in the query's state, and write the changed ones below the folder, batch by batch.

    A batch that is delivered again writes the same rows to the same place.
    """
    spark = messages.sparkSession
    use_rocksdb(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn(state.BATCH, F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{folder}/{_ROWS}={batch_id}")

    writer = current_rows(messages, entity).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


#: Folders of the batches; the name does not clash with a column of the rows.
_ROWS = "rows"


def read_state(spark: SparkSession, entity: Entity, folder: str) -> DataFrame:
    """The current rows from what the query has written: the latest batch's row of each key."""
    parts = spark.read.schema(state.part_schema(entity)).option("basePath", folder).parquet(folder)
    return state.live_rows(state.latest_parts(parts, entity), entity)
