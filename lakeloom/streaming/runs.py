"""Drain-and-stop stream runs: append, per-batch append and per-batch upsert."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lakeloom.operators.layout import files_for
from lakeloom.operators.upsert import KeyedTable
from lakeloom.session import ROCKSDB_STATE, conf_scope
from lakeloom.sources.files import stored_bytes

STATE_PARTITION_BYTES = 128 << 20
PROGRESS_KEPT = 1000
#: Wait for the last events of a query that has ended.
LISTENER_SECONDS = 60


def state_settings(spark: SparkSession, source_path: str, partitions: int | None = None) -> dict[str, str]:
    """State store settings for a stateful run.

    Spark fixes the number of state partitions for the life of a checkpoint. Give
    ``partitions`` for the size the state will grow to; without it the source's
    present bytes decide, which suits a source that is there already.
    """
    if partitions is None:
        partitions = max(8, files_for(stored_bytes(spark, source_path), STATE_PARTITION_BYTES))
    return {
        **ROCKSDB_STATE,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.numRecentProgressUpdates": str(PROGRESS_KEPT),
    }


def _late_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-late"


class LateRows(StreamingQueryListener):
    """Keeps the number of rows that the watermark dropped, for each batch of one
    query. Each number is a small file beside the checkpoint, written when Spark tells
    a batch's progress; a replayed batch overwrites its own."""

    def __init__(self, spark: SparkSession, name: str, checkpoint: str):
        self.spark, self.name, self.folder = spark, name, _late_folder(checkpoint)
        self.by_batch: dict[int, int] = {}
        self.run_id: str | None = None
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or not progress.stateOperators:
            return
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        held = self.by_batch.get(progress.batchId)
        if held is not None and held >= dropped:
            return
        self.by_batch[progress.batchId] = dropped
        if dropped:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{progress.batchId}.json")
            out = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).create(path, True)
            out.writeBytes(json.dumps({"batch_id": progress.batchId, "late": dropped}))
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.ended.set()


def finish(spark: SparkSession, checkpoint: str, start: Callable[[str], StreamingQuery]) -> StreamingQuery:
    """Run a query under a name of its own until all available input is processed; a
    failure is raised here. The late rows of its batches are stored meanwhile."""
    watcher = LateRows(spark, f"run-{uuid.uuid4().hex}", checkpoint)
    spark.streams.addListener(watcher)
    try:
        query = start(watcher.name)
        try:
            query.awaitTermination()
        finally:
            watcher.ended.wait(LISTENER_SECONDS)  # events follow the query
    finally:
        spark.streams.removeListener(watcher)
    query.late_by_batch = dict(watcher.by_batch)
    return query


def drain(df: DataFrame, path: str, checkpoint: str, settings: dict[str, str] | None = None) -> StreamingQuery:
    """Append everything available to a Parquet folder, then stop."""
    with conf_scope(df.sparkSession, settings or {}):
        return finish(df.sparkSession, checkpoint, lambda name: (
            df.writeStream.queryName(name).format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        ))


def drain_to_table(df: DataFrame, table: str, path: str, checkpoint: str,
                   settings: dict[str, str] | None = None) -> StreamingQuery:
    """As ``drain``, into an external catalog table."""
    with conf_scope(df.sparkSession, settings or {}):
        return finish(df.sparkSession, checkpoint, lambda name: (
            df.writeStream.queryName(name).format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .option("path", path)
            .trigger(availableNow=True)
            .toTable(table)
        ))


def drain_batches(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return finish(df.sparkSession, checkpoint, lambda name: (
        df.writeStream.queryName(name).foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    ))


def append_batches(path: str, log: Callable[[int, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch handler that appends batches and reports the size of non-empty ones.

    Rows are stored under ``batch_id=...``; a replayed batch replaces its own
    partition, so a crash between write and checkpoint adds nothing twice. The
    size is observed during the write, and an empty batch writes no file, so the
    batch is computed once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        counter = Observation()
        (
            batch.observe(counter, F.count("*").alias("rows"))
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )
        rows = counter.get["rows"]
        if log and rows:
            log(batch_id, rows)

    return handle


def upsert_batches(path: str, keys: Sequence[str], buckets: int, metrics_path: str | None = None,
                   newest: Sequence[str] = (), tie_breaks: Sequence[str] = (),
                   only_newer: bool = False) -> Callable[[DataFrame, int], None]:
    """A batch handler that upserts into a keyed table and stores the metrics of
    each non-empty batch under its ``batch_id``; a replayed batch finds its upsert
    done and stores the same metrics. With ``only_newer`` the table
    holds the latest row per key, in whatever order rows arrive."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = KeyedTable(spark, path)
        if not table.exists():
            table.create(batch.limit(0), keys, buckets)
        metrics = table.upsert(batch, newest, tie_breaks, only_newer, tag=f"batch-{batch_id}").as_dict()
        if metrics_path and metrics["source_rows"]:
            (
                spark.createDataFrame([metrics], ", ".join(f"{name} bigint" for name in metrics))
                .withColumn("batch_id", F.lit(batch_id))
                .coalesce(1)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id")
                .parquet(metrics_path)
            )

    return handle


def insert_absent_batches(path: str, keys: Sequence[str], buckets: int, newest: Sequence[str] = (),
                          tie_breaks: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A batch handler that adds only rows with unseen keys: deduplication for all
    time with the table itself as its memory, in place of a state store."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, path)
        if not table.exists():
            table.create(batch.limit(0), keys, buckets)
        table.insert_if_absent(batch, newest, tie_breaks)

    return handle


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped by the watermark in all batches of a finished run, every copy of a
    deduplicated key counted. (Spark combines rows before a windowed aggregate, so
    there it counts combined rows.)"""
    return sum(query.late_by_batch.values())


def late_by_batch(query: StreamingQuery) -> dict[int, int]:
    return dict(query.late_by_batch)


def stored_late_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Late rows by batch of all runs over a checkpoint, whichever driver ran them;
    batches without any are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_late_folder(checkpoint))
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    schema = "batch_id bigint, late bigint"
    return spark.read.schema(schema).json(_late_folder(checkpoint)) if files.exists(path) else spark.createDataFrame([], schema)
