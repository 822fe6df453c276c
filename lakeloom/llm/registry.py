"""Queries of this package, kept apart from those of the rest of the library."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lakeloom.queries.registry import Registered, Run
from lakeloom.session import pin_utc

LLM_REGISTRY: dict[str, Registered] = {}


def register(sql: str | None = None) -> Callable[[Run], Run]:
    def add(function: Run) -> Run:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin_utc(spark), sf_dir)

        LLM_REGISTRY[function.__name__] = Registered(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
