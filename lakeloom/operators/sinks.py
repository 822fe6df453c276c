"""Batch writers and catalog tables over Parquet."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from lakeloom.sources.files import FILE_FORMATS

_SCHEMAS = "_schemas"

# Text forms that keep microseconds.
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_files(df: DataFrame, path: str, file_format: str, mode: str = "append") -> None:
    """Write Parquet, JSON or CSV (with header); text keeps full time precision."""
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file format must be one of {', '.join(FILE_FORMATS)}: {file_format}")
    writer = df.write.mode(mode).format(file_format)
    if file_format != "parquet":
        writer = writer.options(**TEXT_TIMES)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def land(df: DataFrame, base: str, run_stamp: str, name: str = "batch") -> str:
    """Append to the landing folder of one run, ``<base>/<name>_<run_stamp>``."""
    folder = f"{base}/{name}_{run_stamp}"
    df.write.mode("append").parquet(folder)
    return folder


def land_dated(df: DataFrame, base: str, file_date: str) -> str:
    """Append below ``file_date=...``, which readers discover as a column."""
    folder = f"{base}/file_date={file_date}"
    df.write.mode("append").parquet(folder)
    return folder


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may carry new columns. The merged schema is kept beside the
    rows, before they are added, so a reader opens no footers to find it. A folder
    written without one gets the merged schema of its files as its first."""
    spark = df.sparkSession
    known = stored_schema(spark, path)
    if known is None:
        known = _footer_schema(spark, path)
        if known is not None:
            store_schema(spark, path, known)
    wide = widened(known, df.schema)
    if known is None or len(wide) > len(known):
        store_schema(spark, path, wide)
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    schema = stored_schema(spark, path)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", "true").parquet(path)


def widened(known: StructType | None, new: StructType) -> StructType:
    """The known columns, then the new ones; a column keeps its type."""
    fields = {field.name: field for field in known.fields} if known else {}
    for field in new.fields:
        held = fields.setdefault(field.name, StructField(field.name, field.dataType))
        if held.dataType != field.dataType:
            raise ValueError(f"column {field.name} is stored as {held.dataType.simpleString()}")
    return StructType(list(fields.values()))


def store_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Add a version to the schemas kept beside the rows."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("append").text(f"{path}/{_SCHEMAS}")


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns of all versions, so that two appends at once lose none."""
    try:
        rows = spark.read.text(f"{path}/{_SCHEMAS}", wholetext=True).collect()
    except AnalysisException:
        return None
    schema = None
    for version in sorted((StructType.fromJson(json.loads(row["value"])) for row in rows), key=len):
        schema = widened(schema, version)
    return schema


def _footer_schema(spark: SparkSession, path: str) -> StructType | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException:  # no folder, or no file in it
        return None


def append_run(df: DataFrame, path: str, run_id: str, run_column: str = "_run_id") -> int:
    """Store one run's rows in its own partition folder and return their number.

    The folder is overwritten whole: a retry adds nothing twice, and one without rows
    leaves none. The count rides on the write, so the source is read once.
    """
    counter = Observation()
    df.drop(run_column).observe(counter, F.count("*").alias("rows")).write.mode("overwrite").parquet(
        _run_folder(path, run_id, run_column))
    return counter.get["rows"]


def _run_folder(path: str, run_id: str, run_column: str) -> str:
    """A partition folder; characters that paths reserve are written as Spark does."""
    name = "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{}[]^\x7f' or ord(c) < 32 else c for c in run_id)
    return f"{path}/{run_column}={name}"


def read_run(spark: SparkSession, path: str, run_id: str, run_column: str = "_run_id") -> DataFrame:
    """One run's rows; only that run's folder is listed."""
    rows = spark.read.parquet(_run_folder(path, run_id, run_column))
    return rows.withColumn(run_column, F.lit(run_id))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def two_level_name(table: str) -> tuple[str, str]:
    parts = table.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"expected <schema>.<table>: {table}")
    return parts[0], parts[1]


def create_table(spark: SparkSession, table: str, columns: str, path: str, comment: str | None = None,
                 properties: Mapping[str, str] | None = None) -> None:
    """An external Parquet table, created if missing."""
    note = f" COMMENT '{_quoted(comment)}'" if comment else ""
    pairs = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in (properties or {}).items())
    props = f" TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{_quoted(path)}'{note}{props}")


def register_table(df: DataFrame, table: str, path: str, mode: str = "overwrite",
                   partition_by: tuple[str, ...] = ()) -> None:
    """Write a frame as an external Parquet table."""
    df.write.mode(mode).option("path", path).partitionBy(*partition_by).format("parquet").saveAsTable(table)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace a table's content, matching columns by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {row["key"]: row["value"] for row in rows}


def table_comment(spark: SparkSession, table: str) -> str | None:
    return spark.catalog.getTable(table).description


def current_context(spark: SparkSession) -> tuple[str, str]:
    """Current catalog and schema."""
    return spark.catalog.currentCatalog(), spark.catalog.currentDatabase()


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
