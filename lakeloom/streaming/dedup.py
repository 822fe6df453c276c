"""Streaming deduplication with watermarks, by Spark's own stateful operators.

They keep the first row of a key that arrives and send all copies of a key to one
task, which is fit for keys with a bounded number of copies. For hot keys use
``lakeloom.streaming.memory``, or for all time ``insert_absent_batches`` or
``upsert_batches`` in ``lakeloom.streaming.runs``: they deduplicate each micro-batch
with map-side combining and keep the memory in a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _watermarked(df: DataFrame, event_time: str, delay: str) -> DataFrame:
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def dedup_by_event_time(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """First row per (keys, event time); state of passed event times is dropped."""
    return _watermarked(df, event_time, delay).dropDuplicates([*keys, event_time])


def dedup_by_key(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """First row per key for all time. Late rows are dropped, but every key stays
    in state, which grows with the number of keys; run it on a RocksDB state
    store, or prefer ``dedup_within_watermark``."""
    return _watermarked(df, event_time, delay).dropDuplicates(list(keys))


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """First row per key, with state bounded by the watermark delay: copies closer
    in event time than the delay are removed."""
    return _watermarked(df, event_time, delay).dropDuplicatesWithinWatermark(list(keys))
