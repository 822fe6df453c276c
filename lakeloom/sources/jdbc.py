"""JDBC reads and writes whose heavy part is pushed into the source database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class JdbcTable:
    """One table of a database.

    With ``partitions`` above 1 a read is split into parallel range scans over
    ``partition_column`` (numeric, date or timestamp); incremental reads split
    over the watermark column when none is named.
    """

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    partitions: int = 1
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table."""
        return self._read_split(spark, self.partition_column)

    def _read_split(self, spark: SparkSession, column: str | None,
                    bounds: tuple[Any, Any] | None = None) -> DataFrame:
        """``bounds`` only shape the splits, they drop no row."""
        options = {**self.options(), "dbtable": self.table}
        if column and self.partitions > 1:
            low, high = bounds or self.bounds(spark, column)
            if low is not None:
                options |= {
                    "partitionColumn": column,
                    "lowerBound": str(low),
                    "upperBound": str(high),
                    "numPartitions": str(self.partitions),
                }
        return spark.read.format("jdbc").options(**options).load()

    def bounds(self, spark: SparkSession, column: str) -> tuple[Any, Any]:
        """MIN and MAX of a column, evaluated inside the database."""
        query = f"SELECT MIN({column}) AS low_value, MAX({column}) AS high_value FROM {self.table}"
        return tuple(spark.read.format("jdbc").options(**self.options(), query=query).load().first())

    def high_value(self, spark: SparkSession, column: str) -> Any:
        """MAX of a column, evaluated inside the database."""
        query = f"SELECT MAX({column}) AS high_value FROM {self.table}"
        return spark.read.format("jdbc").options(**self.options(), query=query).load().first()[0]

    def read_between(self, spark: SparkSession, column: str, low: datetime, high: datetime) -> DataFrame:
        """Rows with ``low < column <= high``; a plain Spark predicate, which the
        JDBC relation pushes down in the database's own dialect."""
        split_by = self.partition_column or column
        bounds = None
        if split_by == column and self.partitions > 1:
            # Splits begin where rows do: a first load starts long before them.
            first, _ = self.bounds(spark, column)
            bounds = (low if first is None else max(low, first), high)
        rows = self._read_split(spark, split_by, bounds)
        return rows.where((F.col(column) > F.lit(low)) & (F.col(column) <= F.lit(high)))

    def append(self, df: DataFrame, batch_size: int = 10_000) -> None:
        """Append rows; a retried task may insert its rows twice, so the target
        needs a unique key if that matters."""
        (
            df.write.format("jdbc").mode("append")
            .options(**self.options(), dbtable=self.table, batchsize=str(batch_size))
            .save()
        )


@dataclass(frozen=True)
class FrameTable:
    """The same reading interface over any DataFrame, such as a Parquet table."""

    df: DataFrame

    def high_value(self, spark: SparkSession, column: str) -> Any:
        return self.df.agg(F.max(column)).first()[0]

    def read_between(self, spark: SparkSession, column: str, low: datetime, high: datetime) -> DataFrame:
        return self.df.where((F.col(column) > self._bound(column, low)) & (F.col(column) <= self._bound(column, high)))

    def _bound(self, column: str, value: datetime) -> Column:
        """A bound in the column's own type, so that the filter reaches the scan."""
        kind = self.df.schema[column].dataType.simpleString()
        return F.lit(str(value)).cast(kind) if kind == "timestamp_ntz" else F.lit(value).cast(kind)
