"""Keyed tables on plain Parquet: create, append, upsert, insert if absent.

A keyed table is a folder of Parquet partitioned by ``bkt``, a hash of the key.
An upsert rewrites only buckets that hold a matched key; rows of other buckets
are appended as new files. New files are first written to a staged folder, then a
small record says that they are complete, and only then are they moved into
place. The next writer finishes a move that was cut short, so no row is lost wherever
the driver stops; a reader changes nothing and reads staged files where they are.
Columns added later are null in rows written before. Limits: one writer at a time, no
snapshots for concurrent readers, no history; the driver holds the numbers of touched
buckets and moves files.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from lakeloom.operators.dedup import latest_per_key
from lakeloom.operators.sinks import store_schema, stored_schema, widened
from lakeloom.sources.files import stored_files

BUCKET = "bkt"
_INFO = "_keyed"
_STAGED = "_staged"
_PENDING = "_pending"
_LAST = "_last"
_BUCKETS = "_buckets"


@dataclass(frozen=True)
class UpsertMetrics:
    """Row counts of one upsert, named as merge metrics usually are."""

    source_rows: int
    inserted: int
    updated: int
    copied: int
    deleted: int = 0

    @property
    def output_rows(self) -> int:
        return self.inserted + self.updated + self.copied

    def as_dict(self) -> dict[str, int]:
        return {**asdict(self), "output_rows": self.output_rows}


def bucket_count(expected_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets so that one holds about ``bucket_bytes``."""
    return max(1, math.ceil(expected_bytes / bucket_bytes))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key. A null key part cannot identify a row, so it stops
    the job instead of losing the row."""
    some_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return F.when(some_null, F.raise_error(F.lit(f"null in key {list(keys)}"))).otherwise(bucket)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched target rows take all source columns; unmatched source rows are
    added. ``source`` must hold one row per key."""
    return _updated(target, source, keys).drop("_matched").unionByName(absent_rows(target, source, keys))


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks."""
    return target.unionByName(absent_rows(target, source, keys))


def replace_listed(target: DataFrame, key: str, values: Sequence, rows: DataFrame) -> DataFrame:
    """Delete the rows whose key is listed, then add ``rows``."""
    listed = F.coalesce(F.col(key).isin(list(values)), F.lit(False))
    return target.where(~listed).unionByName(rows)


def set_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Conditional update: new values where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({
        name: F.when(hit, value.cast(df.schema[name].dataType)).otherwise(F.col(name))
        for name, value in changes.items()
    })


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys present in the target; never more than the source.

    With a source small enough to broadcast, Spark moves the semi join below the
    distinct and does not shuffle the target. With a large one the distinct stays
    first: repeated target keys are combined before the shuffle, whose
    partitioning the join then reuses.
    """
    return target.select(*keys).distinct().join(source.select(*keys), list(keys), "left_semi")


def absent_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.join(matched_keys(target, source, keys), list(keys), "left_anti")


def _updated(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: Sequence[str] = ()) -> DataFrame:
    """Every target row once, with source values where its key matches and, if
    ``newer_by`` is given, where the source row is not older (nulls are oldest)."""
    values = [name for name in target.columns if name not in keys]
    incoming = source.select(*keys, F.struct(F.lit(True).alias("_present"), *values).alias("_new"))
    joined = target.join(incoming, list(keys), "left")
    hit = F.col("_new").isNotNull()
    if newer_by:
        arrived = F.struct(*[F.col(f"_new.{name}").alias(name) for name in newer_by])
        hit = hit & (arrived >= F.struct(*newer_by))
    return joined.select(
        *keys,
        *[F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name) for name in values],
        hit.alias("_matched"),
    ).select(*target.columns, "_matched")


class KeyedTable:
    """A keyed Parquet table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._known: dict | None = None

    def _hadoop_conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def exists(self) -> bool:
        if self._known is None:
            info = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{_INFO}")
            return info.getFileSystem(self._hadoop_conf()).exists(info)
        return True

    def _info(self) -> dict:
        if self._known is None:
            text = self.spark.read.text(f"{self.path}/{_INFO}", wholetext=True).first()["value"]
            self._known = json.loads(text)
        return self._known

    @property
    def keys(self) -> list[str]:
        return self._info()["keys"]

    @property
    def buckets(self) -> int:
        grown = self._record(_BUCKETS)
        return grown["buckets"] if grown else self._info()["buckets"]

    def schema(self) -> StructType:
        """The columns of the first version, then those added since."""
        first = StructType.fromJson(self._info()["schema"])
        later = stored_schema(self.spark, self.path)
        return widened(first, later) if later else first

    def rows(self) -> DataFrame:
        """All rows. Where a commit has been recorded but not moved yet, its staged
        files are read in place of those they replace; nothing is written."""
        pending = self._record(_PENDING)
        if not pending:
            return self._reader().parquet(self.path).drop(BUCKET)
        staged = self._bucket_folders(pending["staged"])
        gone = {f"{BUCKET}={bucket}" for bucket in pending["replace"]} & set(staged)
        gone |= {f"{BUCKET}={bucket}" for bucket in pending.get("empty", ())}
        kept = [f"{self.path}/{name}" for name in self._bucket_folders("") if name not in gone]
        parts = [self._reader().parquet(*kept)] if kept else []
        if staged:
            base = f"{self.path}/{pending['staged']}"
            parts.append(self._reader(base).parquet(*[f"{base}/{name}" for name in staged]))
        return reduce(DataFrame.unionByName, parts).drop(BUCKET)

    def _bucket_folders(self, below: str) -> list[str]:
        path, files = self._hadoop(below) if below else self._hadoop(".")
        names = [folder.getPath().getName() for folder in files.listStatus(path)] if files.exists(path) else []
        return [name for name in names if name.startswith(f"{BUCKET}=")]

    def _hadoop(self, name: str):
        """A path below the table and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self._hadoop_conf())

    def _record(self, name: str) -> dict | None:
        path, files = self._hadoop(name)
        if not files.exists(path):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()["value"])

    def _set_record(self, name: str, value: dict) -> None:
        """Written aside and renamed, so that a record is there whole or not at all."""
        aside = f"{_STAGED}-{name}-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.text(f"{self.path}/{aside}")
        path, files = self._hadoop(name)
        files.delete(path, True)
        if not files.rename(self._hadoop(aside)[0], path):
            raise OSError(f"cannot store {path}")

    def recover(self) -> None:
        """Finish a commit that was cut short and remove what incomplete ones left.
        Writers do so before they begin."""
        pending = self._record(_PENDING)
        if pending:
            self._move(pending)
        root, files = self._hadoop(".")
        for folder in files.listStatus(root) if files.exists(root) else []:
            if folder.getPath().getName().startswith(_STAGED):
                files.delete(folder.getPath(), True)

    def _move(self, pending: dict) -> None:
        """Move staged files into place. Each step can be repeated: a bucket that was
        moved is no longer staged."""
        staged, files = self._hadoop(pending["staged"])
        replaced = set(pending["replace"])
        for folder in files.listStatus(staged) if files.exists(staged) else []:
            name = folder.getPath().getName()
            if not name.startswith(f"{BUCKET}="):
                continue
            target = self._hadoop(name)[0]
            if int(name.split("=")[1]) in replaced:
                files.delete(target, True)
                self._rename(files, folder.getPath(), target)
                continue
            files.mkdirs(target)
            for part in files.listStatus(folder.getPath()):
                self._rename(files, part.getPath(), self._hadoop(f"{name}/{part.getPath().getName()}")[0])
        for bucket in pending.get("empty", ()):
            files.delete(self._hadoop(f"{BUCKET}={bucket}")[0], True)
        if pending.get("buckets"):
            self._set_record(_BUCKETS, {"buckets": pending["buckets"]})
        if pending["tag"] is not None:
            self._set_record(_LAST, {"tag": pending["tag"], "metrics": pending["metrics"]})
        files.delete(self._hadoop(_PENDING)[0], True)
        files.delete(staged, True)
        self.spark.catalog.refreshByPath(self.path)

    def _rename(self, files, source, target) -> None:
        if not files.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")

    def _reader(self, base: str | None = None) -> DataFrameReader:
        return self.spark.read.schema(self.schema().add(BUCKET, IntegerType())).option("basePath", base or self.path)

    def _buckets(self, wanted: Iterable[int]) -> DataFrame:
        """Rows of some buckets. Their folders are named to the reader, so the
        files of other buckets are not even listed."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folders = hadoop_path.getFileSystem(self._hadoop_conf()).listStatus(hadoop_path)
        present = {folder.getPath().getName() for folder in folders}
        names = [name for name in (f"{BUCKET}={bucket}" for bucket in wanted) if name in present]
        if len(names) == sum(name.startswith(f"{BUCKET}=") for name in present):
            return self._reader().parquet(self.path)
        if not names:
            return self._reader().parquet(self.path).limit(0)
        return self._reader().parquet(*[f"{self.path}/{name}" for name in names])

    def create(self, df: DataFrame, keys: Sequence[str], buckets: int,
               newest: Sequence[str] = (), tie_breaks: Sequence[str] = ()) -> None:
        """Write the first version, one row per key."""
        keys = list(keys)
        rows = latest_per_key(df, keys, newest or keys, tie_breaks)
        self._write(rows.withColumn(BUCKET, bucket_of(keys, buckets)), "overwrite", replace="static")
        info = json.dumps({"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue()})
        self.spark.createDataFrame([(info,)], "value string").coalesce(1).write.text(f"{self.path}/{_INFO}")

    def _conformed(self, df: DataFrame, evolve: bool = False) -> DataFrame:
        """``df`` with the table's columns in order. Further columns are added to the
        table with ``evolve`` and an error without; lacking ones are an error."""
        held = self.schema()
        more = [field.name for field in df.schema.fields if field.name not in held.names]
        if more:
            if not evolve:
                raise ValueError(f"columns the table lacks: {more}")
            held = widened(held, df.schema)
            store_schema(self.spark, self.path, held)
        return df.select(*[F.col(f"`{name}`") for name in held.names])

    def append(self, df: DataFrame, tag: str | None = None, evolve: bool = False) -> UpsertMetrics:
        """Add rows without looking for their keys. Nothing is done if the last commit
        carried the same ``tag``."""
        self.recover()
        done = self._done(tag)
        if done:
            return done
        rows = self._conformed(df, evolve).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        return self._stage(rows.withColumn("_matched", F.lit(None).cast("boolean")), None, None, [], tag)

    def _done(self, tag: str | None) -> UpsertMetrics | None:
        last = self._record(_LAST) if tag is not None else None
        return UpsertMetrics(**last["metrics"]) if last and last["tag"] == tag else None

    @contextmanager
    def _incoming(self, df: DataFrame, newest: Sequence[str], tie_breaks: Sequence[str],
                  evolve: bool = False) -> Iterator[tuple[DataFrame, dict[int, int]]]:
        """The source, one row per key with its bucket, held for several uses;
        and its row count per bucket."""
        keys, buckets = self.keys, self.buckets
        latest = latest_per_key(self._conformed(df, evolve), keys, newest or keys, tie_breaks)
        source = latest.withColumn(BUCKET, bucket_of(keys, buckets)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield source, {row[BUCKET]: row["count"] for row in source.groupBy(BUCKET).count().collect()}
        finally:
            source.unpersist()

    def upsert(self, df: DataFrame, newest: Sequence[str] = (), tie_breaks: Sequence[str] = (),
               only_newer: bool = False, tag: str | None = None, evolve: bool = False) -> UpsertMetrics:
        """Update all columns of matched rows and insert the others. With
        ``only_newer`` a stored row gives way only to a row not older by the
        ``newest`` columns, so that late arrivals do not undo later ones. If the last
        commit carried the same ``tag``, nothing is done and its metrics are returned.
        Columns the table lacks are an error, or with ``evolve`` added to it."""
        self.recover()
        done = self._done(tag)
        if done:
            return done
        keys = self.keys  # they name the bucket; the source is dealt by them already, so joins by them do not shuffle it
        with self._incoming(df, newest, tie_breaks, evolve) as (source, per_bucket):
            if not per_bucket:
                return UpsertMetrics(0, 0, 0, 0)
            matched = matched_keys(self._buckets(per_bucket), source, keys).withColumn(
                BUCKET, bucket_of(keys, self.buckets)).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                hits = {row[BUCKET]: row["count"] for row in matched.groupBy(BUCKET).count().collect()}
                new = source.join(matched.select(*keys), keys, "left_anti") if hits else source
                rows = new.withColumn("_matched", F.lit(None).cast("boolean"))
                if hits:
                    rows = _updated(
                        self._buckets(hits), source.where(F.col(BUCKET).isin(list(hits))), keys, newest if only_newer else ()
                    ).unionByName(rows)
                total = sum(per_bucket.values())
                return self._stage(rows, total, total - sum(hits.values()), sorted(hits), tag)
            finally:
                matched.unpersist()

    def insert_if_absent(self, df: DataFrame, newest: Sequence[str] = (), tie_breaks: Sequence[str] = ()) -> None:
        """Add only rows whose key is not stored yet, one per key."""
        self.recover()
        with self._incoming(df, newest, tie_breaks) as (source, per_bucket):
            if per_bucket:
                fresh = absent_rows(self._buckets(per_bucket), source, self.keys)
                self._stage(fresh.withColumn("_matched", F.lit(None).cast("boolean")), None, None, [], None)

    def compact(self, max_files: int = 8) -> int:
        """Rewrite the buckets that appends have left with more than ``max_files``
        files; returns how many there were."""
        self.recover()
        bucket = F.regexp_extract("path", f"/{BUCKET}=([0-9]+)/", 1).cast("int").alias(BUCKET)
        files = stored_files(self.spark, self.path).groupBy(bucket).count()
        crowded = [row[BUCKET] for row in files.where(F.col("count") > max_files).collect()]
        if crowded:
            rows = self._buckets(crowded).withColumn("_matched", F.lit(False))
            self._stage(rows, 0, 0, crowded, None)
        return len(crowded)

    def grow(self, buckets: int) -> None:
        """Split every bucket, so that the number set at creation is not final: bucket b
        of n becomes b, b + n, b + 2n and so on of a multiple of n. A task writes parts
        of the buckets it reads, so rows are not shuffled."""
        self.recover()
        before = self.buckets
        if buckets <= before or buckets % before:
            raise ValueError(f"not a multiple of {before} buckets: {buckets}")
        old = [int(name.split("=")[1]) for name in self._bucket_folders("")]
        staged = f"{_STAGED}-{uuid.uuid4().hex}"
        rows = self._reader().parquet(self.path).withColumn(BUCKET, bucket_of(self.keys, buckets))
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/{staged}")
        filled = {int(name.split("=")[1]) for name in self._bucket_folders(staged)}
        pending = {"staged": staged, "replace": old, "empty": [bucket for bucket in old if bucket not in filled],
                   "buckets": buckets, "tag": None, "metrics": None}
        self._set_record(_PENDING, pending)
        self._move(pending)

    def write(self, df: DataFrame, keys: Sequence[str], buckets: int, mode: str = "merge",
              newest: Sequence[str] = (), tie_breaks: Sequence[str] = ()) -> UpsertMetrics | None:
        """First run creates the table; later runs append or merge."""
        if mode not in ("merge", "append"):
            raise ValueError(f"mode must be merge or append: {mode}")
        if not self.exists():
            self.create(df, keys, buckets, newest, tie_breaks)
        elif mode == "append":
            self.append(df)
        else:
            return self.upsert(df, newest, tie_breaks)
        return None

    def _write(self, df: DataFrame, mode: str, replace: str = "dynamic") -> None:
        """The rebalance hint lets adaptive execution split an oversized bucket
        into several files and join small ones into one task."""
        self._save(df.hint("rebalance", BUCKET), mode, replace)

    def _stage(self, df: DataFrame, total: int | None, inserted: int | None, replace: list[int], tag: str | None) -> UpsertMetrics:
        """Write rows aside, record that they are complete, move them into place.
        Updated and copied rows (and, where no total is given, inserted ones) are
        observed after the shuffle, in the writing stage, so that a map task repeated
        after the loss of an executor is not counted twice."""
        counts = Observation()
        watched = df.hint("rebalance", BUCKET).observe(
            counts,
            F.count_if(F.col("_matched")).alias("updated"),
            F.count_if(~F.col("_matched")).alias("copied"),
            F.count_if(F.col("_matched").isNull()).alias("inserted"),
        )
        staged = f"{_STAGED}-{uuid.uuid4().hex}"
        watched.drop("_matched").write.partitionBy(BUCKET).parquet(f"{self.path}/{staged}")
        seen = counts.get
        if inserted is None:
            total = inserted = seen["inserted"]
        metrics = UpsertMetrics(total, inserted, seen["updated"], seen["copied"])
        pending = {"staged": staged, "replace": replace, "tag": tag, "metrics": asdict(metrics)}
        self._set_record(_PENDING, pending)
        self._move(pending)
        return metrics

    def _save(self, df: DataFrame, mode: str, replace: str) -> None:
        df.write.mode(mode).option("partitionOverwriteMode", replace).partitionBy(BUCKET).parquet(self.path)
        self.spark.catalog.refreshByPath(self.path)

