"""Batch deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in columns]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exactly one row per key: the first in the given order.

    The ``row_number() = 1`` filter is planned with a group limit below the
    exchange, so each map task sends at most one row per key, however many copies
    a hot key has.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                   tie_breaks: Sequence[str] = ()) -> DataFrame:
    """Latest wins, nulls last; tie breaks make the choice repeatable."""
    return first_per_key(df, keys, newest_first(*newest, *tie_breaks))
