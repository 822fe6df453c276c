"""One keyed event table fed by batch files and by an event stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeloom.functions.events import EVENT_ID, conform_events, decode_envelope, with_event_id
from lakeloom.operators.upsert import KeyedTable, UpsertMetrics
from lakeloom.streaming.runs import drain_batches, upsert_batches

# Newest arrival wins when a batch holds several copies of one event.
ARRIVAL = ("enqueuedTime", "etlLoadTs")
TIE_BREAKS = ("sequence", "deviceId", "temperatureC", "status")


def batch_events(df: DataFrame, moment: datetime | None = None, strict: bool = False) -> DataFrame:
    return with_event_id(conform_events(df, moment), strict)


def stream_events(envelope: DataFrame, moment: datetime | None = None, strict: bool = False) -> DataFrame:
    return with_event_id(decode_envelope(envelope, moment), strict)


def load_batch(spark: SparkSession, df: DataFrame, path: str, buckets: int, mode: str = "merge",
               moment: datetime | None = None) -> UpsertMetrics | None:
    """Create, append to or merge into the table at ``path``."""
    table = KeyedTable(spark, path)
    return table.write(batch_events(df, moment), [EVENT_ID], buckets, mode, ARRIVAL, TIE_BREAKS)


def load_stream(envelope: DataFrame, path: str, checkpoint: str, buckets: int,
                metrics_path: str | None = None, moment: datetime | None = None) -> StreamingQuery:
    """Upsert every micro-batch of an envelope stream into the same table."""
    handle = upsert_batches(path, [EVENT_ID], buckets, metrics_path, ARRIVAL, TIE_BREAKS)
    return drain_batches(stream_events(envelope, moment), checkpoint, handle)
