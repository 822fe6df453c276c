"""Rerunnable chains from landed files to served views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.functions.events import EVENT_COLUMNS, event_time
from lakeloom.functions.shaping import normalized, with_file_lineage
from lakeloom.operators.aggregates import create_view, top_counts
from lakeloom.operators.dedup import latest_per_key
from lakeloom.operators.expectations import DEVICE_EVENT_EXPECTATIONS, Expectation, keep_valid
from lakeloom.sources.files import file_stream, persisted_schema
from lakeloom.streaming.dedup import dedup_by_event_time
from lakeloom.streaming.runs import drain, drain_to_table, state_settings


def ingest_files(spark: SparkSession, path: str, state: str, table: str, table_path: str,
                 moment: datetime | None = None, file_format: str = "parquet",
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """New files of a landing folder into a bronze table, with lineage; schema and
    checkpoint live below ``state``, so a rerun takes only files not yet seen."""
    schema = persisted_schema(spark, path, file_format, f"{state}/schema")
    stream = with_file_lineage(file_stream(spark, path, schema, file_format, max_files_per_trigger), moment)
    return drain_to_table(stream, table, table_path, f"{state}/checkpoint")


def refine_table(spark: SparkSession, bronze: str, bronze_path: str, silver_path: str, checkpoint: str,
                 keys: Sequence[str], event_time_column: str, delay: str = "1 day",
                 max_files_per_trigger: int | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """New bronze rows, deduplicated per key and event time, into silver.

    ``max_files_per_trigger`` caps a micro-batch, so that a backlog is worked off in
    steps; ``state_partitions`` is for the size the state will grow to.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.table(bronze)
    return drain(
        dedup_by_event_time(rows, keys, event_time_column, delay),
        silver_path, checkpoint, state_settings(spark, bronze_path, state_partitions),
    )


def serve_top(spark: SparkSession, silver_path: str, view: str, key: str, k: int = 20,
              name: str = "row_count") -> DataFrame:
    return create_view(top_counts(spark.read.parquet(silver_path), key, k, name), view)


def silver_events(bronze: DataFrame, rules: Sequence[Expectation] = DEVICE_EVENT_EXPECTATIONS,
                  moment: datetime | None = None) -> DataFrame:
    """Bronze device events to silver: cleaned strings, parsed time, expectations,
    then the latest arrival per (deviceId, sequence).

    Expectations come before the deduplication, so a broken newest copy does not
    take its key with it.
    """
    cleaned = normalized(bronze, trims=["deviceId"], uppers=["status"])
    valid = keep_valid(cleaned.withColumn("event_ts", event_time("timestamp")), rules)
    latest = latest_per_key(
        valid, ["deviceId", "sequence"], ["enqueuedTime", "etlLoadTs"],
        ["timestamp", "temperatureC", "status", "sequenceNumber", "offset"],
    )
    stamp = F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")
    first, *others = EVENT_COLUMNS
    return latest.select(first, "event_ts", *others, stamp.alias("silver_timestamp"))
