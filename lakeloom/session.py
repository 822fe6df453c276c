"""Session helpers: builder, scoped settings, adaptive profiles, scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ADAPTIVE_OFF = {"spark.sql.adaptive.enabled": "false"}

ADAPTIVE_ON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
}

ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting stored rows costs a read before every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_local_scratch: str | None = None


def build_session(app: str = "lakeloom", master: str | None = None,
                  settings: Mapping[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_ON, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without zone are read as UTC everywhere in this library."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def conf_scope(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply runtime settings for the duration of a block, then restore them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder; on a cluster a
    missing setting is an error, because executors could not see the files.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="lakeloom-")
        base = _local_scratch
    return os.path.join(base.rstrip("/"), f"{label}-{uuid.uuid4().hex}")
