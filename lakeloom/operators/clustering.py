"""Incremental clustering, file skipping and compaction of stored tables.

A clustered table is a folder with one ``run=<number>`` folder a clustering job, and
two small Parquet tables beside them: which source files each run has taken, and the
range of every clustered column in each file written. A run first stores the files it
takes, then writes its folder as one job. If it was cut short, the next run does the
same files again into the same folder, so each source file is taken exactly once,
whatever its modification time. Limits: one clustering job at a time, and source
files stay in place until their run has ended.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.operators.layout import SORTED_FILE_BYTES, TARGET_FILE_BYTES, cluster, file_bounds, files_for
from lakeloom.sources.files import stored_files

RUN = "run"
_TAKEN = "_taken"
_BOUNDS = "_bounds"
_STAGED = "_packed"
_PENDING = "_packing"


class Compaction(NamedTuple):
    """File counts of one compaction in place."""

    rewritten: int
    written: int
    untouched: int


def _path(spark: SparkSession, name: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _path(spark, name)
    return files.exists(path)


def _literal(name: str) -> str:
    """A path that the reader does not take for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", name)


def _read_files(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    """Some files of a folder, with the columns that its partition folders name."""
    parted = any("=" in name.rsplit("/", 2)[1] for name in names)
    reader = spark.read.option("basePath", base) if parted else spark.read
    return reader.parquet(*map(_literal, names))


def _runs(spark: SparkSession, target: str) -> tuple[list[int], list[int]]:
    """Numbers of the runs that have taken files, and of those that have ended."""
    taken, files = _path(spark, f"{target}/{_TAKEN}")
    if not files.exists(taken):
        return [], []
    numbers = sorted(
        int(folder.getPath().getName().split("=")[1]) for folder in files.listStatus(taken)
        if folder.getPath().getName().startswith(f"{RUN}=") and _exists(spark, f"{folder.getPath()}/_SUCCESS"))
    return numbers, [number for number in numbers if _exists(spark, f"{target}/{_BOUNDS}/{RUN}={number}/_SUCCESS")]


def new_files(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Source files that no run has taken: the listing without the ledger."""
    listed = stored_files(spark, path).select("path", "length")
    numbers, _ = _runs(spark, target)
    if not numbers:
        return listed
    taken = spark.read.parquet(*[f"{target}/{_TAKEN}/{RUN}={number}" for number in numbers])
    return listed.join(taken.select("path"), "path", "left_anti")


def cluster_new(spark: SparkSession, path: str, target: str, columns: Sequence[str],
                file_bytes: int = SORTED_FILE_BYTES, bits: int = 8) -> int:
    """Cluster the files below ``path`` that are new since the last run and add them
    to ``target``; returns how many were taken. A run that was cut short comes first."""
    numbers, ended = _runs(spark, target)
    for number in numbers:
        if number not in ended:
            _run(spark, path, target, number, columns, file_bytes, bits)
    fresh = new_files(spark, path, target).collect()  # names, as the reader needs them
    if not fresh:
        return 0
    number = max(numbers, default=-1) + 1
    spark.createDataFrame([tuple(row) for row in fresh], "path string, length long").coalesce(1).write.mode(
        "overwrite").parquet(f"{target}/{_TAKEN}/{RUN}={number}")
    _run(spark, path, target, number, columns, file_bytes, bits)
    return len(fresh)


def _run(spark: SparkSession, path: str, target: str, number: int, columns: Sequence[str], file_bytes: int, bits: int) -> None:
    taken = spark.read.parquet(f"{target}/{_TAKEN}/{RUN}={number}").collect()
    rows = _read_files(spark, path, [row["path"] for row in taken])
    folder = f"{target}/{RUN}={number}"
    cluster(rows, folder, columns, files_for(sum(row["length"] for row in taken), file_bytes), bits)
    store_bounds(spark.read.parquet(folder), f"{target}/{_BOUNDS}/{RUN}={number}", columns)


def store_bounds(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write the range of each column in each file that ``df`` reads."""
    file_bounds(df, columns).coalesce(1).write.mode("overwrite").parquet(path)


def read_clustered(spark: SparkSession, target: str) -> DataFrame:
    """All rows of runs that have ended."""
    _, ended = _runs(spark, target)
    return spark.read.parquet(*[f"{target}/{RUN}={number}" for number in ended])


def stored_bounds(spark: SparkSession, target: str) -> DataFrame:
    _, ended = _runs(spark, target)
    return spark.read.parquet(*[f"{target}/{_BOUNDS}/{RUN}={number}" for number in ended])


def _within(ranges: Mapping[str, tuple], test) -> Column:
    condition = F.lit(True)
    for name, (low, high) in ranges.items():
        condition = condition & test(name, F.lit(low), F.lit(high))
    return condition


def matching_files(bounds: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Files whose stored ranges overlap every given one (both ends included)."""
    return bounds.where(_within(ranges, lambda name, low, high: (F.col(f"min_{name}") <= high) & (F.col(f"max_{name}") >= low)))


def read_matching(spark: SparkSession, target: str, ranges: Mapping[str, tuple]) -> tuple[DataFrame, int]:
    """Rows of a clustered table within ranges of its clustered columns, and how many
    files are opened for them. Files outside are neither listed nor opened."""
    names = [row["file_path"] for row in matching_files(stored_bounds(spark, target), ranges).select(
        F.url_decode(F.regexp_replace("file_path", r"\+", "%2B")).alias("file_path")).collect()]
    inside = _within(ranges, lambda name, low, high: F.col(f"`{name}`").between(low, high))
    if not names:
        return read_clustered(spark, target).where(F.lit(False)), 0
    return spark.read.parquet(*map(_literal, names)).where(inside), len(names)


def compact_small(spark: SparkSession, path: str, file_bytes: int = TARGET_FILE_BYTES, small: float = 0.5) -> Compaction:
    """Pack the files below ``small`` times ``file_bytes`` into files of about
    ``file_bytes``, in place; larger files are not read. The scan sorts files by size
    and packs them into splits, so nothing is shuffled. New files are staged, a record
    says that they are complete, then they are moved in and the small ones deleted; the
    next call finishes that if the driver was lost. A plain folder, not a partitioned
    one; a reader between the two steps sees rows twice."""
    finish_compaction(spark, path)
    files = stored_files(spark, path)
    sizes = files.agg(F.count("*").alias("n")).first()["n"]
    few = [row["path"] for row in files.where(F.col("length") < small * file_bytes).select("path").collect()]
    if len(few) < 2:
        return Compaction(0, 0, sizes)
    staged = f"{_STAGED}-{uuid.uuid4().hex}"
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", "0")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    packing.read.parquet(*map(_literal, few)).write.parquet(f"{path}/{staged}")
    written = stored_files(spark, f"{path}/{staged}").count()
    aside, record = f"{path}/{_PENDING}-{staged}", f"{path}/{_PENDING}"
    spark.createDataFrame([(json.dumps({"staged": staged, "replaced": few}),)], "value string").coalesce(1).write.text(aside)
    where, system = _path(spark, record)
    system.rename(_path(spark, aside)[0], where)
    finish_compaction(spark, path)
    return Compaction(len(few), written, sizes - len(few))


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Move a complete compaction into place. Each step may be repeated."""
    record, files = _path(spark, f"{path}/{_PENDING}")
    if not files.exists(record):
        return
    pending = json.loads(spark.read.text(f"{path}/{_PENDING}", wholetext=True).first()["value"])
    staged = _path(spark, f"{path}/{pending['staged']}")[0]
    for part in files.listStatus(staged) if files.exists(staged) else []:
        if part.getPath().getName().endswith(".parquet"):
            if not files.rename(part.getPath(), _path(spark, f"{path}/{part.getPath().getName()}")[0]):
                raise OSError(f"cannot move {part.getPath()}")
    for name in pending["replaced"]:
        files.delete(_path(spark, name)[0], False)
    files.delete(record, True)
    files.delete(staged, True)
    spark.catalog.refreshByPath(path)
