"""Registration of runnable queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from lakeloom.session import pin_utc

Run = Callable[[SparkSession, str], DataFrame]


class Registered(NamedTuple):
    run: Run
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name. Results carry timestamps without
    zone, as the input tables do."""
    def add(function: Run) -> Run:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = function(pin_utc(spark), sf_dir)
            zoned = {
                field.name: F.col(field.name).cast("timestamp_ntz")
                for field in result.schema.fields if isinstance(field.dataType, TimestampType)
            }
            return result.withColumns(zoned) if zoned else result

        REGISTRY[function.__name__] = Registered(run, sql)
        return run

    return add
