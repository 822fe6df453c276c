"""Queries over deduplication, expectations and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakeloom.operators import quality as dq
from lakeloom.operators.expectations import DEVICE_EVENT_EXPECTATIONS, keep_invalid, keep_valid, rule_counts
from lakeloom.plans.medallion import silver_events
from lakeloom.queries.inputs import (
    DEVICE_EVENTS_SQL, ORDER_DETAIL_SQL, ORDER_HEADER_SQL, RUN_TIME, TRANSACTION_HISTORY_SQL,
    device_events, order_detail, order_header, transaction_history,
)
from lakeloom.queries.registry import register
from lakeloom.session import scratch_path

VALID_SQL = """coalesce(deviceId IS NOT NULL AND trim(deviceId) <> ''
  AND "timestamp" IS NOT NULL AND trim("timestamp") <> ''
  AND sequence IS NOT NULL AND sequence >= 0, FALSE)"""


@register(f"""
WITH d AS ({DEVICE_EVENTS_SQL}),
ranked AS (
  SELECT * REPLACE (trim(deviceId) AS deviceId, upper(trim(status)) AS status),
         row_number() OVER (PARTITION BY trim(deviceId), sequence
                            ORDER BY enqueuedTime DESC NULLS LAST, etlLoadTs DESC NULLS LAST) AS position
  FROM d WHERE {VALID_SQL})
SELECT * EXCLUDE (position), CAST("timestamp" AS TIMESTAMP) AS event_ts,
       TIMESTAMP '2024-02-02' AS silver_timestamp
FROM ranked WHERE position = 1
""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver device events: expectations, then the latest row per key."""
    return silver_events(device_events(spark, sf_dir), moment=RUN_TIME)


@register(f"WITH d AS ({DEVICE_EVENTS_SQL}) SELECT * FROM d WHERE {VALID_SQL}")
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(device_events(spark, sf_dir), DEVICE_EVENT_EXPECTATIONS)


@register(f"WITH d AS ({DEVICE_EVENTS_SQL}) SELECT * FROM d WHERE NOT {VALID_SQL}")
def expect_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_invalid(device_events(spark, sf_dir), DEVICE_EVENT_EXPECTATIONS)


_RULE_TESTS = {
    "valid_deviceId": "deviceId IS NOT NULL AND trim(deviceId) <> ''",
    "valid_timestamp": "\"timestamp\" IS NOT NULL AND trim(\"timestamp\") <> ''",
    "valid_sequence": "sequence IS NOT NULL AND sequence >= 0",
}


@register(f"WITH d AS ({DEVICE_EVENTS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (coalesce({test}, FALSE)) AS passed, "
    f"count(*) FILTER (NOT coalesce({test}, FALSE)) AS failed FROM d"
    for name, test in _RULE_TESTS.items()
))
def expect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(device_events(spark, sf_dir), DEVICE_EVENT_EXPECTATIONS)


@register(f"WITH d AS ({DEVICE_EVENTS_SQL}) SELECT count(*) AS rows_in, " + ", ".join(
    f"count(*) FILTER (NOT coalesce({test}, FALSE)) AS \"{name}\"" for name, test in _RULE_TESTS.items()
) + f", count(*) FILTER ({VALID_SQL}) AS rows_out FROM d")
def expect_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts taken while the valid rows are written."""
    out, counters = scratch_path(spark, "silver"), Observation()
    keep_valid(device_events(spark, sf_dir), DEVICE_EVENT_EXPECTATIONS, counters).write.parquet(out)
    counted = [F.lit(value).cast("bigint").alias(name) for name, value in counters.get.items()]
    return spark.read.parquet(out).agg(F.count("*").alias("rows_out")).select(*counted, "rows_out")


DETAIL, HEADER, HISTORY = "bronze.order_detail", "bronze.order_header", "bronze.transaction_history"
DETAIL_KEYS, HEADER_KEYS, HISTORY_KEYS = ["SalesOrderID", "SalesOrderDetailID"], ["SalesOrderID"], ["TransactionID"]

# Required columns that the stand-in tables have.
DETAIL_REQUIRED = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
                   "ModifiedDate"]
HEADER_REQUIRED = ["SalesOrderID", "OrderDate", "DueDate", "ShipDate", "SubTotal", "TaxAmt", "Freight", "TotalDue"]
HISTORY_REQUIRED = ["TransactionID", "ProductID", "TransactionType", "Quantity", "ActualCost"]

# The business rules, as (name, broken condition, severity).
DETAIL_RULES = [
    ("orderqty_positive", "OrderQty <= 0", dq.FAIL),
    ("unitprice_non_negative", "UnitPrice < 0", dq.FAIL),
    ("unitpricediscount_valid", "UnitPriceDiscount < 0 OR UnitPriceDiscount > 1", dq.WARN),
    ("linetotal_non_negative", "LineTotal < 0", dq.FAIL),
]
HEADER_RULES = [
    ("totaldue_non_negative", "TotalDue < 0", dq.FAIL),
    ("subtotal_non_negative", "SubTotal < 0", dq.FAIL),
    ("taxamt_non_negative", "TaxAmt < 0", dq.FAIL),
    ("freight_non_negative", "Freight < 0", dq.FAIL),
    ("duedate_gte_orderdate", "DueDate < OrderDate", dq.WARN),
    ("shipdate_gte_orderdate_when_present", "ShipDate IS NOT NULL AND ShipDate < OrderDate", dq.WARN),
]
HISTORY_RULES = [
    ("quantity_not_zero", "Quantity = 0", dq.WARN),
    ("actualcost_non_negative", "ActualCost < 0", dq.WARN),
    ("transactiontype_allowed", "TransactionType NOT IN ('W', 'S', 'P')", dq.WARN),
]


def _rules(rules: list[tuple[str, str, str]]) -> list[dq.Rule]:
    return [dq.Rule(name, F.expr(broken), severity) for name, broken, severity in rules]


def _tables(spark: SparkSession, sf_dir: str) -> list[dq.TableChecks]:
    return [
        dq.TableChecks(DETAIL, order_detail(spark, sf_dir), DETAIL_KEYS, DETAIL_REQUIRED, _rules(DETAIL_RULES)),
        dq.TableChecks(HEADER, order_header(spark, sf_dir), HEADER_KEYS, HEADER_REQUIRED, _rules(HEADER_RULES)),
        dq.TableChecks(HISTORY, transaction_history(spark, sf_dir), HISTORY_KEYS, HISTORY_REQUIRED,
                       _rules(HISTORY_RULES)),
    ]


def _full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    detail, header, _ = tables
    lines = [dq.check_table(checks) for checks in tables]
    lines.append(dq.reference_checks(
        "SalesOrderID",
        dq.Side(DETAIL, detail.rows, "ref_check_detail_has_header", "SalesOrderID in detail not found in header"),
        dq.Side(HEADER, header.rows, "ref_check_header_has_detail", "SalesOrderID in header not found in detail"),
    ))
    return dq.report(lines)


_SOURCES_SQL = f"detail AS ({ORDER_DETAIL_SQL}), header AS ({ORDER_HEADER_SQL}), history AS ({TRANSACTION_HISTORY_SQL})"


def _line_sql(table: str, check: str, severity: str, metric: str, problem: str) -> str:
    text = problem.replace("'", "''")
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", "
        f"CASE WHEN n > 0 THEN '{severity}' ELSE 'PASS' END AS status, "
        f"CASE WHEN n > 0 THEN n END AS metric, CASE WHEN n > 0 THEN '{text}' END AS details FROM ({metric})"
    )


def _constant_sql(table: str, check: str, details: str | None) -> str:
    note = f"'{details}'" if details else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{table}', '{check}', 'PASS', CAST(NULL AS BIGINT), {note}"


def _table_sql(table: str, alias: str, keys: list[str], required: list[str], rules: list) -> list[str]:
    nulls = " OR ".join(f"{key} IS NULL" for key in keys)
    group = ", ".join(keys)
    lines = [
        _line_sql(table, "null_check_key_cols", "FAIL", f"SELECT count(*) AS n FROM {alias} WHERE {nulls}",
                  f"Nulls found in {keys}"),
        _constant_sql(table, "not_empty", None),
        _constant_sql(table, "required_columns_exist", f"{len(required)} columns present"),
        _line_sql(table, "duplicate_check_key_cols", "FAIL",
                  f"SELECT count(*) AS n FROM (SELECT {group} FROM {alias} GROUP BY {group} HAVING count(*) > 1)",
                  f"Duplicate keys on {keys}"),
    ]
    return lines + [
        _line_sql(table, name, severity, f"SELECT count(*) AS n FROM {alias} WHERE {broken}", f"Bad rows where {name}")
        for name, broken, severity in rules
    ]


def _unmatched_sql(left: str, right: str) -> str:
    return (
        f"SELECT count(*) AS n FROM (SELECT DISTINCT SalesOrderID FROM {left}) l "
        f"WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE r.SalesOrderID = l.SalesOrderID)"
    )


REPORT_SQL = f"WITH {_SOURCES_SQL} " + " UNION ALL ".join([
    *_table_sql(DETAIL, "detail", DETAIL_KEYS, DETAIL_REQUIRED, DETAIL_RULES),
    *_table_sql(HEADER, "header", HEADER_KEYS, HEADER_REQUIRED, HEADER_RULES),
    *_table_sql(HISTORY, "history", HISTORY_KEYS, HISTORY_REQUIRED, HISTORY_RULES),
    _line_sql(DETAIL, "ref_check_detail_has_header", "WARN", _unmatched_sql("detail", "header"),
              "SalesOrderID in detail not found in header"),
    _line_sql(HEADER, "ref_check_header_has_detail", "WARN", _unmatched_sql("header", "detail"),
              "SalesOrderID in header not found in detail"),
])


@register(REPORT_SQL)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of three tables, worst first."""
    return _full_report(spark, sf_dir)


@register(f"""
SELECT count(*) FILTER (status = 'FAIL') AS fail_count, count(*) FILTER (status = 'WARN') AS warn_count,
       count(*) FILTER (status = 'FAIL') = 0 AS passed
FROM ({REPORT_SQL})
""")
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over the stored report, which runs no check again."""
    return dq.gate_counts(dq.stored_report(_full_report(spark, sf_dir), scratch_path(spark, "report")))


def _key_sql(keys: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({key} AS VARCHAR), 'null')" for key in keys) + ")"


@register(f"WITH {_SOURCES_SQL} " + " UNION ALL ".join(
    f"SELECT \"check\", sample_key FROM (SELECT '{name}' AS \"check\", {_key_sql(keys)} AS sample_key, "
    f"row_number() OVER (ORDER BY md5({_key_sql(keys)})) AS place FROM {alias} WHERE {broken}) WHERE place <= 20"
    for alias, keys, rules in (
        ("detail", DETAIL_KEYS, DETAIL_RULES), ("header", HEADER_KEYS, HEADER_RULES), ("history", HISTORY_KEYS, HISTORY_RULES))
    for name, broken, _ in rules
))
def dq_failing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offending rows that the sample of each rule shows, 20 at most."""
    samples = reduce(DataFrame.unionByName, [dq.failing_samples(checks) for checks in _tables(spark, sf_dir)])
    return samples.select("check", "sample_key")


def _only(lines: DataFrame, *checks: str) -> DataFrame:
    return lines.where(F.col("check").isin(list(checks)))


@register(f"""
WITH {_SOURCES_SQL}, none AS (SELECT * FROM history WHERE Quantity < 0)
SELECT '{DETAIL}' AS "table", 'not_empty' AS "check",
       CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN count(*) = 0 THEN 'Table has 0 rows (after run_id filter)' END AS details FROM detail
UNION ALL
SELECT '{HISTORY}', 'not_empty', CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END,
       CASE WHEN count(*) = 0 THEN 'Table has 0 rows (after run_id filter)' END FROM none
""")
def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table fails and its other checks are skipped."""
    detail = dq.TableChecks(DETAIL, order_detail(spark, sf_dir), DETAIL_KEYS, DETAIL_REQUIRED)
    nothing = transaction_history(spark, sf_dir).where("Quantity < 0")
    empty = dq.TableChecks(HISTORY, nothing, HISTORY_KEYS, HISTORY_REQUIRED)
    emptied = dq.check_table(empty, scoped=True)
    return _only(dq.scan_checks(detail, scoped=True), "not_empty").unionByName(emptied).drop("metric")


@register(f"""
WITH {_SOURCES_SQL}
SELECT '{HEADER}' AS "table", 'required_columns_exist' AS "check", 'FAIL' AS status,
       'Missing: [''rowguid'', ''CustomerID'']' AS details, count(*) > 0 AS has_rows FROM header
UNION ALL SELECT '{HEADER}', 'not_empty', 'PASS', NULL, count(*) > 0 FROM header
""")
def dq_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing columns fail and the later checks are skipped."""
    header = order_header(spark, sf_dir)
    checks = dq.TableChecks(HEADER, header, HEADER_KEYS, [*HEADER_REQUIRED, "rowguid", "CustomerID"],
                            _rules(HEADER_RULES))
    lines = dq.check_table(checks).drop("metric")
    return lines.withColumn("has_rows", F.lit(not header.isEmpty()))


@register(f"WITH {_SOURCES_SQL} " + _line_sql(
    DETAIL, "null_check_key_cols", "FAIL",
    "SELECT count(*) AS n FROM detail WHERE SalesOrderID IS NULL OR SalesOrderDetailID IS NULL",
    f"Nulls found in {DETAIL_KEYS}",
))
def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = dq.TableChecks(DETAIL, order_detail(spark, sf_dir), DETAIL_KEYS, DETAIL_REQUIRED)
    return _only(dq.scan_checks(checks), "null_check_key_cols")


@register(f"""
WITH {_SOURCES_SQL}
SELECT SalesOrderID, SalesOrderDetailID, count(*) AS count FROM detail
GROUP BY ALL HAVING count(*) > 1
""")
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.duplicate_keys(order_detail(spark, sf_dir), DETAIL_KEYS)


@register(f"""
WITH {_SOURCES_SQL}
SELECT SalesOrderID, SalesOrderDetailID, count(*) AS count FROM detail
GROUP BY ALL HAVING count(*) > 1
ORDER BY count DESC, SalesOrderID NULLS FIRST, SalesOrderDetailID NULLS FIRST LIMIT 20
""")
def dq_worst_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.worst_duplicates(order_detail(spark, sf_dir), DETAIL_KEYS, 20)


@register(f"WITH {_SOURCES_SQL} " + " UNION ALL ".join(
    _line_sql(table, name, severity, f"SELECT count(*) AS n FROM {alias} WHERE {broken}", f"Bad rows where {name}")
    for table, alias, rules in ((DETAIL, "detail", DETAIL_RULES), (HEADER, "header", HEADER_RULES),
                                (HISTORY, "history", HISTORY_RULES))
    for name, broken, severity in rules
))
def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirteen business rules of three tables."""
    tables = _tables(spark, sf_dir)
    names = [rule.name for checks in tables for rule in checks.rules]
    return _only(dq.report([dq.scan_checks(checks) for checks in tables]), *names)


@register(f"""
WITH {_SOURCES_SQL}
SELECT DISTINCT SalesOrderID FROM detail d
WHERE NOT EXISTS (SELECT 1 FROM header h WHERE h.SalesOrderID = d.SalesOrderID)
""")
def dq_ref_child_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail keys without a header (the missing key counts as one)."""
    return dq.keys_without_match(order_detail(spark, sf_dir), order_header(spark, sf_dir), "SalesOrderID")


@register(f"""
WITH {_SOURCES_SQL}
SELECT DISTINCT SalesOrderID FROM header h
WHERE NOT EXISTS (SELECT 1 FROM detail d WHERE d.SalesOrderID = h.SalesOrderID)
""")
def dq_ref_parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.keys_without_match(order_header(spark, sf_dir), order_detail(spark, sf_dir), "SalesOrderID")
