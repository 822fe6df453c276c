"""Joins with hot keys where adaptive execution is off or cannot split them.

Heavy hitters come from a mergeable frequency sketch, built in one aggregate pass.
Rows of these keys alone are salted, and the other side's rows of these keys are
repeated once a salt; all other rows are joined as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from lakeloom.operators.layout import _row_salt

_SALT = "_salt"
#: Keys that the sketch keeps track of.
TRACKED = 10_000


def hot_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = TRACKED) -> list:
    """Keys that hold at least ``share`` of the rows, most frequent first: at most
    1 / ``share``. The sketch's counts are lower bounds, short by at most about 3 rows
    in ``tracked``, so ``share`` should be well above that."""
    if not 4 / tracked <= share <= 1:
        raise ValueError(f"share must lie between {4 / tracked} and 1: {share}")
    most = math.ceil(1 / share)
    found = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).agg(
        F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] >= share * found["n"]]


def join_salted(fact: DataFrame, dimension: DataFrame, key: str, hot: list, salts: int = 32) -> DataFrame:
    """Inner join by ``key``; rows of ``hot`` keys are dealt over ``salts`` parts by a
    hash of the row, so that a repeated task deals them alike. ``dimension`` rows of
    hot keys are repeated ``salts`` times, other rows not."""
    if not hot:
        return fact.join(dimension, key)
    is_hot = F.col(key).isin(hot)
    one, two = (frame.withColumn(_SALT, salt) for frame, salt in (
        (fact, F.when(is_hot, _row_salt(fact, salts).cast("int")).otherwise(0)),
        (dimension, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))))
    return one.join(two, [key, _SALT]).drop(_SALT)
