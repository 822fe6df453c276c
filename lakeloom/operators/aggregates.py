"""Grouped and global aggregates, star joins and top-k reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def maxima(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.agg(*[F.max(name).alias(f"max_{name}") for name in columns])


def filtered_sum(df: DataFrame, condition: Column, value: Column, name: str) -> DataFrame:
    return df.where(condition).agg(F.sum(value).alias(name))


def grouped_mean_and_sum(df: DataFrame, key: str, value: str, digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(
        F.round(F.avg(value), digits).alias(f"avg_{value}"),
        F.round(F.sum(value), digits).alias(f"total_{value}"),
    )


def grouped_sums(df: DataFrame, keys: Mapping[str, Column], sums: Mapping[str, Column],
                 condition: Column | None = None, count_as: str | None = None,
                 more: Mapping[str, Column] | None = None) -> DataFrame:
    """Filter, then group by computed keys; sums and counts are combined map-side,
    which shrinks hot groups before the shuffle. ``more`` adds other aggregates."""
    rows = df if condition is None else df.where(condition)
    measures = [F.sum(value).alias(name) for name, value in sums.items()]
    measures += [value.alias(name) for name, value in (more or {}).items()]
    if count_as:
        measures.insert(0, F.count("*").alias(count_as))
    return rows.groupBy(*[value.alias(name) for name, value in keys.items()]).agg(*measures)


def star_join_sums(fact: DataFrame, dimension: DataFrame, join_key: str | Sequence[str],
                   keys: Mapping[str, Column], sums: Mapping[str, Column],
                   count_as: str = "row_cnt") -> DataFrame:
    """Fact joined to a dimension, then grouped.

    Join the fact to its largest dimension first and give the result as ``fact``: a
    join of dimensions is estimated as a product of sizes, beside which the fact looks
    small enough to broadcast. No hint is given: Spark broadcasts a side whose
    estimated size is under the threshold, and otherwise sorts and merges, where
    adaptive skew handling splits a hot join key. The grouping keys do not include the join
    key, so that split stays possible, and partial aggregation runs in the join's
    own stage.
    """
    return grouped_sums(fact.join(dimension, join_key), keys, sums, count_as=count_as)


def distinct_estimate(df: DataFrame, keys: Iterable[str], value: str, error: float = 0.05) -> DataFrame:
    return df.groupBy(*keys).agg(F.approx_count_distinct(value, error).alias(f"approx_{value}"))


def distinct_sketches(df: DataFrame, keys: Iterable[str], value: str, lg_k: int = 12) -> DataFrame:
    """A sketch of the distinct values per group, to be stored: groups are merged for
    coarser keys later, so that a new day costs its own rows only."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias(f"{value}_sketch"))


def merged_sketches(sketches: DataFrame, keys: Iterable[str], value: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_union_agg(f"{value}_sketch").alias(f"{value}_sketch"))


def sketched_distinct(sketches: DataFrame, keys: Iterable[str], value: str) -> DataFrame:
    """Estimated distinct values of coarser groups, off by about 1.04 / sqrt(2 ** lg_k)
    (one standard error, 1.6 % for lg_k 12). A sketch united with itself is estimated
    from its registers alone, whatever the order in which parts were merged."""
    sketch = F.col(f"{value}_sketch")
    return merged_sketches(sketches, keys, value).withColumn(
        f"approx_{value}", F.hll_sketch_estimate(F.hll_union(sketch, sketch))).drop(f"{value}_sketch")


def top_counts(df: DataFrame, key: str, k: int = 20, name: str = "row_count") -> DataFrame:
    """The k most frequent keys; equal counts are ordered by key."""
    return df.groupBy(key).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc(key)).limit(k)


def latest_rows(df: DataFrame, k: int, newest: str, *tie_breaks: str) -> DataFrame:
    return df.orderBy(F.desc(newest), *tie_breaks).limit(k)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register a stored query; it is evaluated at every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
