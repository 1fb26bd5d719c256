"""The streaming query that feeds a change store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import configure
from tidemark.streaming import stateful
from tidemark.streaming.store import ChangeStore

_QUERY_ID = "sql.streaming.queryId"


def start_ingest(
    messages: DataFrame, store: ChangeStore, checkpoint: str, interval: str | None = None, repeats: bool = True
) -> StreamingQuery:
    """Consume a stream of messages (topic, partition, offset, value).

    Without an interval the query takes all that is available and ends. A restart from the same
    checkpoint keeps the query id, under which the store remembers the last batch it committed.

    With `repeats`, for sources that may deliver a message twice such as landed files, each message is let through once,
    from the positions in the query's state. A broker gives each offset once per query: without `repeats` no batch is shuffled.
    """
    spark = store.spark
    configure(spark)
    if repeats:
        stateful.use_rocksdb(spark)
        messages = stateful.each_message_once(messages)

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        store.apply_batch(batch, batch_id, stream=query or checkpoint, unique=True)

    writer = messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def ingest_available(messages: DataFrame, store: ChangeStore, checkpoint: str, repeats: bool = True) -> None:
    """Consume everything available and return."""
    query = start_ingest(messages, store, checkpoint, repeats=repeats)
    try:
        query.awaitTermination()
    finally:
        query.stop()
