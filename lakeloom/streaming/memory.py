"""Streaming deduplication for hot keys, with a table as its memory.

Spark's stateful operators send all copies of a key to one task. Here each
micro-batch first keeps one row per key, by a group limit below the shuffle, so that
a map task sends one row of a key however many copies it holds; then it leaves out
the keys in memory. The memory is a Parquet table of the keys seen, in folders by the
time at which they expire; a batch reads those that can matter, and folders that the
watermark has passed are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.operators.dedup import latest_per_key

SLOT, BATCH = "slot", "batch_id"


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _files(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _files(spark, name)
    return files.exists(path)


def dedup_batches(path: str, memory: str, keys: Sequence[str], event_time: str, delay: timedelta, within: bool = False,
                  newest: Sequence[str] = (), slot: timedelta | None = None) -> Callable[[DataFrame, int], None]:
    """A batch handler that appends the first row of each key to ``path``.

    The key is ``keys`` and the event time, or with ``within`` ``keys`` alone, kept in
    memory until the watermark is ``delay`` past the event time of the row that was
    kept. The watermark is the latest event time of the batches before, less
    ``delay``; rows before it are dropped and counted. Rows without event time are
    neither late nor remembered: one per key and batch is kept. Of copies within a
    batch the earliest is kept, of these the greatest by ``newest`` (all columns, if
    not given). ``memory`` holds the keys, by ``slot`` (a tenth of the delay, if not
    given), and in ``batches`` one row a batch: rows, late rows and the latest event
    time so far. A replayed batch reads the memory of those before it, and replaces
    its own rows.
    """
    wait, width = int(delay.total_seconds() * 1e6), int((slot or delay / 10).total_seconds() * 1e6)
    full_key = list(keys) if within else [*keys, event_time]
    lifetime = wait if within else 0

    def before(spark: SparkSession, batch_id: int) -> int | None:
        """The latest event time of earlier batches."""
        if not _exists(spark, f"{memory}/batches"):
            return None
        last = f"{memory}/batches/{BATCH}={batch_id - 1}"
        rows = spark.read.parquet(last) if _exists(spark, last) else spark.read.parquet(f"{memory}/batches").where(F.col(BATCH) < batch_id)
        return rows.agg(F.max("latest")).first()[0]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = before(spark, batch_id)
        mark = None if latest is None else latest - wait
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            at = _micros(F.col(event_time))
            late = F.coalesce(at < F.lit(mark), F.lit(False)) if mark is not None else F.lit(False)
            seen = held.agg(F.count("*").alias("rows"), F.count_if(late).alias("late"), F.max(at).alias("latest"),
                            F.min(F.when(~late, at)).alias("first")).first()
            if not seen["rows"]:
                return
            order = list(newest) or [name for name in batch.columns if name not in full_key]
            early = held.where(~late).withColumn("_early", -F.coalesce(at, F.lit(0)))
            fresh = latest_per_key(early, full_key, ["_early", *order]).drop("_early")
            if seen["first"] is not None and _exists(spark, f"{memory}/keys"):
                known = spark.read.parquet(f"{memory}/keys").where(F.col(BATCH) < batch_id)
                if not within:
                    known = known.where(F.col(SLOT).between(seen["first"] // width, seen["latest"] // width))
                elif mark is not None:
                    known = known.where((F.col(SLOT) >= mark // width) & (F.col("_expires") > mark))
                fresh = _unseen(known, fresh, full_key)
            fresh.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
            if _exists(spark, f"{path}/{BATCH}={batch_id}"):
                kept = spark.read.schema(batch.schema).parquet(f"{path}/{BATCH}={batch_id}").where(F.col(event_time).isNotNull())
                expires = _micros(F.col(event_time)) + lifetime
                kept.select(*full_key, expires.alias("_expires"), F.floor(expires / width).alias(SLOT), F.lit(batch_id).alias(BATCH)).hint(
                    "rebalance", SLOT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                    SLOT, BATCH).parquet(f"{memory}/keys")
            reached = max(time for time in (latest, seen["latest"], -(1 << 62)) if time is not None)
            spark.createDataFrame([(seen["rows"], seen["late"], reached, batch_id)], f"rows long, late long, latest long, {BATCH} long").coalesce(
                1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{memory}/batches")
            if mark is not None:
                _evict(spark, f"{memory}/keys", mark // width)
        finally:
            held.unpersist()

    return handle


def _unseen(known: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known; nulls are equal. Known keys are first narrowed to
    those that came again, which needs no shuffle of the memory if these are few."""
    def to(other: DataFrame) -> DataFrame:
        return other.select(*[F.col(name).alias(f"_{name}") for name in keys])

    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys])
    again = known.select(*keys).join(to(fresh), same, "left_semi").distinct()
    return fresh.join(to(again), same, "left_anti")


def _evict(spark: SparkSession, keys: str, slot: int) -> None:
    """Delete folders that end before the watermark of a batch that is done: neither a
    later batch nor a replay of this one reads them."""
    path, files = _files(spark, keys)
    for folder in files.listStatus(path) if files.exists(path) else []:
        name = folder.getPath().getName()
        if name.startswith(f"{SLOT}=") and int(name.split("=")[1]) < slot:
            files.delete(folder.getPath(), True)
