"""Streaming form of the event log: new lake files in, new events out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeweave.operators.history import EventLog, content_events


def read_raw_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Files that arrive below a raw source folder; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def incr_content_events_stream(unified: DataFrame) -> DataFrame:
    """Events of a streaming union. No watermark: sources have clocks of their own, and a late event is an event."""
    return content_events(unified)


def start_event_log(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add everything available now to the partitioned log, each id once, then stop; a restart continues from the checkpoint.

    The log itself is the state: a micro-batch adds the ids that its days do not hold yet. So nothing is dropped for being
    late, no state grows, and a batch that is repeated after a failure adds nothing twice.
    """
    log = EventLog(events.sparkSession, path)
    writer = events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, _: log.add(batch)).start()
