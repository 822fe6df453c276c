"""Row expectations: keep, quarantine and count."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F


class Expectation(NamedTuple):
    name: str
    predicate: str


# The three rules of the device-event silver table.
DEVICE_EVENT_EXPECTATIONS = (
    Expectation("valid_deviceId", "deviceId IS NOT NULL AND trim(deviceId) <> ''"),
    Expectation("valid_timestamp", "timestamp IS NOT NULL AND trim(timestamp) <> ''"),
    Expectation("valid_sequence", "sequence IS NOT NULL AND sequence >= 0"),
)


def holds(rule: Expectation) -> Column:
    """True or false, never null: an undecided rule counts as broken."""
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def all_hold(rules: Sequence[Expectation]) -> Column:
    return reduce(and_, [holds(rule) for rule in rules], F.lit(True))


def keep_valid(df: DataFrame, rules: Sequence[Expectation], counters: Observation | None = None) -> DataFrame:
    """Rows that meet every rule. The rules are plain filters, which drop undecided
    rows too and can be pushed into the scan. With ``counters`` the broken rows
    per rule are counted in the same pass, when the result is written; write it
    without a shuffle in between, so that a repeated task is counted once."""
    watched = df
    if counters is not None:
        watched = df.observe(
            counters,
            F.count("*").alias("rows_in"),
            *[F.count_if(~holds(rule)).alias(rule.name) for rule in rules],
        )
    for rule in rules:
        watched = watched.where(rule.predicate)
    return watched


def keep_invalid(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """The exact complement of ``keep_valid``."""
    return df.where(~all_hold(rules))


def rule_counts(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """rule, passed, failed for each rule, from one aggregate pass."""
    counted = df.agg(
        F.count("*").alias("rows_in"),
        *[F.count_if(~holds(rule)).alias(f"broken_{index}") for index, rule in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            (F.col("rows_in") - F.col(f"broken_{index}")).alias("passed"),
            F.col(f"broken_{index}").alias("failed"),
        )
        for index, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))
