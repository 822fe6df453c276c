"""Metadata-driven incremental load of database tables into bronze.

Two small control tables steer it: what to load (``metadata``) and how far each
source got (``watermarks``). Both are keyed tables, so some sources' states are
changed without touching the others. Only control rows reach the driver.

Each source's outcome is noted in a small file of its own as soon as it is done;
the notes of a run enter the watermark table in one commit. A run that was cut
short leaves its notes, and the next one takes them in before it starts. One
loader runs at a time over a control folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lakeloom.functions.shaping import with_run_lineage
from lakeloom.operators.sinks import append_run
from lakeloom.operators.upsert import KeyedTable
from lakeloom.sources.files import path_exists

# Columns of the control tables.
METADATA_SCHEMA = (
    "source_schema string, source_table string, source_table_fqn string, watermark_column string, "
    "load_type string, enabled boolean, target_catalog string, target_schema string, target_table string, "
    "lookback_minutes int, created_at timestamp, updated_at timestamp"
)
WATERMARK_SCHEMA = (
    "source_table_fqn string, watermark_column string, last_successful_watermark timestamp, "
    "current_batch_max_watermark timestamp, last_run_id string, last_run_ts timestamp, "
    "last_row_count bigint, status string, updated_at timestamp"
)
SOURCE_KEY = "source_table_fqn"

# Where a source starts, and the run states.
BEGINNING = datetime(1900, 1, 1)
NEVER_RAN, SUCCESS, FAILED = "NEVER_RAN", "SUCCESS", "FAILED"


class IncrementalSource(Protocol):
    def high_value(self, spark: SparkSession, column: str) -> Any: ...
    def read_between(self, spark: SparkSession, column: str, low: datetime, high: datetime) -> DataFrame: ...


@dataclass(frozen=True)
class LoadResult:
    source: str
    status: str
    rows: int
    watermark: datetime | None
    error: str | None = None


def seed_rows(metadata: DataFrame, moment: datetime) -> DataFrame:
    """First watermark row of every enabled source."""
    return metadata.where("enabled").select(
        SOURCE_KEY, "watermark_column",
        F.lit(BEGINNING).cast("timestamp").alias("last_successful_watermark"),
        F.lit(None).cast("timestamp").alias("current_batch_max_watermark"),
        F.lit(None).cast("string").alias("last_run_id"),
        F.lit(None).cast("timestamp").alias("last_run_ts"),
        F.lit(None).cast("bigint").alias("last_row_count"),
        F.lit(NEVER_RAN).alias("status"),
        F.lit(moment).cast("timestamp").alias("updated_at"),
    )


class IncrementalLoader:
    def __init__(self, spark: SparkSession, control_path: str, bronze_path: str):
        self.spark = spark
        self.bronze_path = bronze_path
        self.metadata = KeyedTable(spark, f"{control_path}/etl_metadata")
        self.watermarks = KeyedTable(spark, f"{control_path}/etl_watermark")
        self.notes_path = f"{control_path}/etl_outcomes"

    def configure(self, rows: Iterable[Row | dict | tuple], moment: datetime) -> None:
        """Store what to load, replacing older settings of the same sources, and
        seed the watermark of sources that have none."""
        settings = self.spark.createDataFrame(list(rows), METADATA_SCHEMA)
        self.metadata.write(settings, [SOURCE_KEY], buckets=1)
        seeds = seed_rows(settings, moment)
        if self.watermarks.exists():
            self.watermarks.insert_if_absent(seeds)
        else:
            self.watermarks.create(seeds, [SOURCE_KEY], buckets=1)

    def bronze(self, target_schema: str, target_table: str) -> str:
        return f"{self.bronze_path}/{target_schema}/{target_table}"

    def run(self, sources: Mapping[str, IncrementalSource], run_id: str, moment: datetime,
            parallel: int = 4) -> list[LoadResult]:
        """Load every enabled source once, a few at a time. A failed source keeps
        its watermark and gets status FAILED; the other sources still run. Each
        outcome is noted as soon as it is known, and all are stored in one commit."""
        self.settle()
        wanted = self.metadata.rows().where("enabled").where(F.col(SOURCE_KEY).isin(list(sources)))
        settings = wanted.orderBy(SOURCE_KEY).collect()
        states = {row[SOURCE_KEY]: row for row in self.watermarks.rows().collect()}
        results = []
        with ThreadPoolExecutor(parallel) as pool:
            running = {
                pool.submit(self._load, setting, states.get(setting[SOURCE_KEY]), sources, run_id, moment): setting
                for setting in settings
            }
            for done in as_completed(running):
                setting = running[done]
                result = self._outcome(setting[SOURCE_KEY], done)
                self._note(result, setting["watermark_column"], states.get(result.source), run_id, moment)
                results.append(result)
        self.settle()
        return sorted(results, key=lambda result: result.source)

    def _load(self, setting: Row, state: Row | None, sources: Mapping[str, IncrementalSource],
              run_id: str, moment: datetime) -> LoadResult:
        name, column = setting[SOURCE_KEY], setting["watermark_column"]
        reached = (state and state["last_successful_watermark"]) or BEGINNING
        low = reached - timedelta(minutes=setting["lookback_minutes"] or 0)
        high = sources[name].high_value(self.spark, column)
        if high is None:
            return LoadResult(name, SUCCESS, 0, None)
        window = sources[name].read_between(self.spark, column, low, high)
        rows = with_run_lineage(window, name, run_id, moment)
        count = append_run(rows, self.bronze(setting["target_schema"], setting["target_table"]), run_id)
        return LoadResult(name, SUCCESS, count, high)

    @staticmethod
    def _outcome(source: str, done: Future) -> LoadResult:
        error = done.exception()
        return done.result() if error is None else LoadResult(source, FAILED, 0, None, str(error))

    def _note(self, result: LoadResult, column: str, state: Row | None, run_id: str, moment: datetime) -> None:
        """Note the source's next row; an empty source or a failure keeps the old
        watermark."""
        kept = state["last_successful_watermark"] if state else None
        last_high = state["current_batch_max_watermark"] if state else None
        row = (
            result.source, column, result.watermark or kept,
            result.watermark if result.status == SUCCESS else last_high,
            run_id, moment, result.rows, result.status, moment,
        )
        self.spark.createDataFrame([row], WATERMARK_SCHEMA).coalesce(1).write.mode("append").parquet(self.notes_path)

    def settle(self) -> None:
        """Take all noted outcomes into the watermark table in one commit. Cut short
        before the notes are emptied, it stores the same rows again: nothing is noted
        before earlier notes are settled."""
        if not path_exists(self.spark, self.notes_path):
            return
        noted = self.spark.read.schema(WATERMARK_SCHEMA).parquet(self.notes_path)
        if noted.isEmpty():
            return
        self.watermarks.upsert(noted, newest=["last_run_ts"], tie_breaks=["last_run_id"])
        self.spark.createDataFrame([], WATERMARK_SCHEMA).write.mode("overwrite").parquet(self.notes_path)
