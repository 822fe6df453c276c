"""Batch and streaming file readers, landing listings and persisted schemas."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FILE_FORMATS = ("parquet", "json", "csv")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_glob(sf_dir: str, name: str) -> str:
    """A stream source must be a folder or a glob, so match the table by glob;
    this holds whether the table is one file or a folder of part files."""
    return f"{sf_dir}/{name}.parque[t]"


def read_files(spark: SparkSession, path: str, file_format: str,
               header: bool = True, schema: StructType | None = None) -> DataFrame:
    """Read a landing folder in one of the supported formats.

    CSV columns come back as strings unless a schema is given. Without a schema
    JSON is read once more to infer it, so give one for large folders.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file format must be one of {', '.join(FILE_FORMATS)}: {file_format}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if file_format == "csv":
        reader = reader.option("header", header)
    return reader.format(file_format).load(path)


def between_dates(df: DataFrame, column: str, start: date | datetime, end: date | datetime) -> DataFrame:
    """Rows whose ``column`` lies in [start, end]; a plain range predicate, so it
    reaches the Parquet scan and prunes row groups."""
    kind = df.schema[column].dataType.simpleString()
    return df.where(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def persisted_schema(spark: SparkSession, path: str, file_format: str, schema_path: str) -> StructType:
    """The schema stored at ``schema_path``, or the one inferred from ``path``,
    which is then stored, so that every later run reads with the same schema."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(schema_path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(hadoop_path):
        text = spark.read.text(schema_path, wholetext=True).first()["value"]
        return StructType.fromJson(json.loads(text))
    schema = read_files(spark, path, file_format).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    return schema


def file_stream(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet",
                max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> DataFrame:
    """A stream over the files of a landing folder; the query's checkpoint makes
    each file count exactly once across runs. A cap by files or by bytes (such as
    ``"100g"``) bounds the size of one micro-batch; use one of the two."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def stored_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """One row per data file below ``path``: path, length, modificationTime.

    The content column of the binary reader is never selected, so only file
    metadata is listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """File count and stored bytes of a table folder."""
    return stored_files(spark, path).agg(
        F.count("*").alias("num_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes"),
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    return int(table_detail(spark, path).first()["size_in_bytes"])


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def subfolders(spark: SparkSession, name: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(str(entry.getPath()) for entry in files.listStatus(path) if entry.isDirectory())


def source_folder(pattern: str) -> Column:
    """A named part of the row's file path."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
