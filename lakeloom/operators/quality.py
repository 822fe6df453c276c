"""Data-quality checks over tables, their report and the pass/fail gate.

All null and rule checks of a table share one aggregate pass. Duplicate and
referential checks aggregate partially before their single shuffle, so a hot key
reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values, here and below: statuses, names of the checks and their detail texts.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

REPORT_SCHEMA = "table string, check string, status string, metric bigint, details string"


class QualityGateError(Exception):
    """The report breaches the gate."""


@dataclass(frozen=True)
class Rule:
    """Rows for which ``broken`` is true count as bad; null does not."""

    name: str
    broken: Column
    severity: str = FAIL


@dataclass(frozen=True)
class TableChecks:
    name: str
    rows: DataFrame
    keys: Sequence[str]
    required: Sequence[str]
    rules: Sequence[Rule] = field(default_factory=tuple)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(key).isNull() for key in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def worst_duplicates(df: DataFrame, keys: Sequence[str], limit: int = 20) -> DataFrame:
    return duplicate_keys(df, keys).orderBy(F.desc("count"), *keys).limit(limit)


def bad_rows(df: DataFrame, broken: Column, limit: int = 20) -> DataFrame:
    """A sample of offending rows for display."""
    return df.where(broken).limit(limit)


def keys_without_match(rows: DataFrame, others: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``rows`` absent from ``others``.

    Both sides are made distinct first; the join reuses the distinct's hash
    partitioning, so each side is shuffled once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return rows.select(*keys).distinct().join(others.select(*keys).distinct(), keys, "left_anti")


def _line(table: str, check: str, severity: str, metric: Column, problem: str) -> Column:
    bad = metric > 0
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.when(bad, severity).otherwise(PASS).alias("status"),
        F.when(bad, metric).alias("metric"),
        F.when(bad, problem).alias("details"),
    )




def scan_checks(checks: TableChecks, scoped: bool = False) -> DataFrame:
    """not_empty, required columns, null keys and rules from one aggregate pass
    without a shuffle of rows. An empty table or missing columns end the list."""
    missing = missing_columns(checks.rows, checks.required)
    testable = not missing
    measures = [F.count("*").alias("rows_in")]
    if testable:
        measures.append(F.count_if(any_null(checks.keys)).alias("null_keys"))
        measures += [F.count_if(rule.broken).alias(f"rule_{i}") for i, rule in enumerate(checks.rules)]
    empty_note = "Table has 0 rows (after run_id filter)" if scoped else "Table has 0 rows"
    emptiness = F.struct(
        F.lit(checks.name).alias("table"), F.lit("not_empty").alias("check"),
        F.when(F.col("rows_in") == 0, FAIL).otherwise(PASS).alias("status"),
        F.lit(None).cast("bigint").alias("metric"),
        F.when(F.col("rows_in") == 0, empty_note).alias("details"),
    )
    required = F.struct(
        F.lit(checks.name).alias("table"), F.lit("required_columns_exist").alias("check"),
        F.lit(PASS if testable else FAIL).alias("status"),
        F.lit(None).cast("bigint").alias("metric"),
        F.lit(f"{len(checks.required)} columns present" if testable else f"Missing: {missing}").alias("details"),
    )
    later = [required]
    if testable:
        later.append(_line(checks.name, "null_check_key_cols", FAIL, F.col("null_keys"),
                           f"Nulls found in {list(checks.keys)}"))
        later += [
            _line(checks.name, rule.name, rule.severity, F.col(f"rule_{i}"), f"Bad rows where {rule.name}")
            for i, rule in enumerate(checks.rules)
        ]
    lines = F.when(F.col("rows_in") == 0, F.array(emptiness)).otherwise(F.array(emptiness, *later))
    return checks.rows.agg(*measures).select(F.inline(lines))


def duplicate_check(checks: TableChecks) -> DataFrame:
    """The duplicate check; silent for an empty table."""
    groups = checks.rows.groupBy(*checks.keys).count()
    counted = groups.agg(F.count("*").alias("groups"), F.count_if(F.col("count") > 1).alias("repeated"))
    line = _line(checks.name, "duplicate_check_key_cols", FAIL, F.col("repeated"),
                 f"Duplicate keys on {list(checks.keys)}")
    return counted.where(F.col("groups") > 0).select(F.inline(F.array(line)))


@dataclass(frozen=True)
class Side:
    """One side of a referential check: where its unmatched keys are reported."""

    table: str
    rows: DataFrame
    check: str
    problem: str


def reference_checks(key: str, child: Side, parent: Side) -> DataFrame:
    """Both directions of a referential check, severity WARN, from one grouping:
    each distinct key is marked with the sides it occurs on. A null key matches
    nothing."""
    marked = child.rows.select(key, F.lit(True).alias("in_child")).unionByName(
        parent.rows.select(key, F.lit(False).alias("in_child"))
    )
    sides = marked.groupBy(key).agg(
        F.bool_or("in_child").alias("in_child"), F.bool_or(~F.col("in_child")).alias("in_parent")
    )
    lone = F.col(key).isNull()
    counted = sides.agg(
        F.count_if(F.col("in_child") & (~F.col("in_parent") | lone)).alias("child_only"),
        F.count_if(F.col("in_parent") & (~F.col("in_child") | lone)).alias("parent_only"),
    )
    lines = [
        _line(side.table, side.check, WARN, F.col(measure), side.problem)
        for side, measure in ((child, "child_only"), (parent, "parent_only"))
    ]
    return counted.select(F.inline(F.array(*lines)))


def check_table(checks: TableChecks, scoped: bool = False) -> DataFrame:
    """All checks of one table."""
    lines = scan_checks(checks, scoped)
    if missing_columns(checks.rows, checks.required):
        return lines
    return lines.unionByName(duplicate_check(checks))


def severity_rank(status: Column) -> Column:
    return (
        F.when(status == FAIL, 2).when(status == WARN, 1).when(status == PASS, 0).otherwise(9)
    )


def report(lines: Sequence[DataFrame]) -> DataFrame:
    """All check lines, worst first."""
    merged = reduce(DataFrame.unionByName, lines)
    return merged.orderBy(F.desc(severity_rank(F.col("status"))), "table", "check")


def gate_counts(lines: DataFrame, fail_on_warn: bool = False) -> DataFrame:
    counted = lines.agg(
        F.count_if(F.col("status") == FAIL).alias("fail_count"),
        F.count_if(F.col("status") == WARN).alias("warn_count"),
    )
    breached = F.col("fail_count") > 0
    if fail_on_warn:
        breached = breached | (F.col("warn_count") > 0)
    return counted.withColumn("passed", ~breached)


def stored_report(lines: DataFrame, path: str) -> DataFrame:
    """The report, written once. Read and gate on the result: the checks' scans and
    shuffles are not run again."""
    lines.coalesce(1).write.mode("overwrite").parquet(path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def failing_samples(checks: TableChecks, limit: int = 20) -> DataFrame:
    """Up to ``limit`` offending rows of each rule, as (check, sample_key, row).

    The rows with the smallest hashes of their keys: any rows to the eye, but the same
    at each run. One scan serves all rules, and a map task sends at most ``limit``
    rows of each.
    """
    names = F.array(*[F.when(rule.broken, F.lit(rule.name)) for rule in checks.rules])
    key = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("null")) for name in checks.keys])
    found = checks.rows.select(
        F.explode(F.array_compact(names)).alias("check"), key.alias("sample_key"), F.to_json(F.struct("*")).alias("row"))
    place = F.row_number().over(Window.partitionBy("check").orderBy(F.md5("sample_key"), "row"))
    return found.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def enforce_gate(lines: DataFrame, fail_on_warn: bool = False, run_id: str | None = None) -> None:
    """Raise when any check failed, or warned if warnings count."""
    outcome = gate_counts(lines, fail_on_warn).first()
    if not outcome["passed"]:
        raise QualityGateError(
            f"validation failed: FAIL={outcome['fail_count']}, WARN={outcome['warn_count']}, run_id={run_id}"
        )
