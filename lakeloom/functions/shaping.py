"""Column shaping: case-insensitive names, conforming schemas, lineage columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def match_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of ``name``, ignoring case."""
    return {existing.lower(): existing for existing in reversed(df.columns)}.get(name.lower())


def canonical_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename columns that differ from ``names`` only in case; a missing one is
    an error that lists what the frame has."""
    spelling = {name: match_column(df, name) for name in names}
    missing = [name for name, found in spelling.items() if found is None]
    if missing:
        raise ValueError(f"columns {missing} not found; the frame has {df.columns}")
    return df.withColumnsRenamed({found: name for name, found in spelling.items()})


def column_or_null(df: DataFrame, name: str, kind: str | None = None) -> Column:
    """The column, or a null literal where the frame lacks it. Casts are lenient:
    text that does not parse becomes null."""
    present = name in df.columns
    if kind is None:
        return F.col(name) if present else F.lit(None)
    if not present:
        return F.lit(None).cast(kind)
    return F.col(name).try_cast(kind)


def conform(df: DataFrame, spec: Mapping[str, str], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Project to exactly the columns of ``spec`` (name to type)."""
    defaults = defaults or {}
    projected = []
    for name, kind in spec.items():
        value = column_or_null(df, name, kind)
        if name in defaults:
            value = F.coalesce(value, defaults[name].cast(kind))
        projected.append(value.alias(name))
    return df.select(*projected)


def new_run_id() -> str:
    return str(uuid.uuid4())


def row_guid() -> Column:
    """A random id per row; store the rows before reading them twice."""
    return F.expr("uuid()")


def load_time(moment: datetime | None = None) -> Column:
    return F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")


def with_file_lineage(df: DataFrame, moment: datetime | None = None) -> DataFrame:
    """Add load_timestamp and source_file; works on batch and streaming files."""
    return df.select(
        "*",
        load_time(moment).alias("load_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def with_run_lineage(df: DataFrame, source: str, run_id: str, moment: datetime | None = None) -> DataFrame:
    return df.withColumns({
        "_ingest_ts": load_time(moment),
        "_source_table_fqn": F.lit(source),
        "_run_id": F.lit(run_id),
    })


def scoped_to_run(df: DataFrame, run_id: str | None) -> DataFrame:
    """Only one run's rows when a run id is given. Bronze tables are partitioned
    by ``_run_id``, so this prunes partitions."""
    return df.where(F.col("_run_id") == run_id) if run_id else df


def normalized(df: DataFrame, trims: Iterable[str] = (), uppers: Iterable[str] = ()) -> DataFrame:
    """Trim some string columns; trim and upper-case others."""
    return df.withColumns(
        {name: F.trim(name) for name in trims} | {name: F.upper(F.trim(name)) for name in uppers}
    )
