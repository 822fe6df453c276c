"""Queries over column shaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.functions.events import decode_envelope, event_id, event_time, without_zulu
from lakeloom.functions.shaping import (
    canonical_columns, conform, normalized, scoped_to_run, with_file_lineage, with_run_lineage,
)
from lakeloom.operators.sinks import append_run, read_run
from lakeloom.queries.inputs import (
    DECODED_SQL, DEVICE_EVENTS_SQL, EVENT_ID_SQL, LOAD_TIME, device_events, envelope, iso_text,
)
from lakeloom.queries.registry import register
from lakeloom.session import scratch_path
from lakeloom.sources.files import fixture
from lakeloom.sources.ranges import REGIONS, TIERS, pick


@register(DECODED_SQL)
def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_envelope(envelope(spark, sf_dir), LOAD_TIME)


@register("""
SELECT o_orderkey AS "vendorID", o_orderdate AS "tpepPickupDateTime",
       o_orderdate + INTERVAL 7 MINUTE AS "tpepDropoffDateTime", o_totalprice AS "tipAmount"
FROM orders
""")
def shape_resolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns found whatever their case, then renamed; others dropped."""
    landed = fixture(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("VENDORID"), F.col("o_orderdate").alias("tpeppickupdatetime"),
        F.expr("o_orderdate + INTERVAL 7 MINUTES").alias("TpepDropoffDatetime"),
        F.col("o_totalprice").alias("tipAmount"), "o_orderpriority",
    )
    wanted = ["vendorID", "tpepPickupDateTime", "tpepDropoffDateTime", "tipAmount"]
    return canonical_columns(landed, wanted).drop("o_orderpriority")


@register("""
SELECT event_id AS sequence, CAST(user_id AS VARCHAR) AS "deviceId", value AS "temperatureC",
       CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS "enqueuedTime",
       CAST(NULL AS VARCHAR) AS status,
       CASE WHEN event_type = 'click' THEN ts ELSE TIMESTAMP '2024-02-01' END AS "etlLoadTs",
       CAST(json_extract(props, '$.k') AS INTEGER) AS units, CAST(round(value, 2) AS DECIMAL(10,2)) AS amount,
       CAST(event_id % 2 AS BOOLEAN) AS flagged
FROM events
""")
def shape_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns cast leniently; a missing column becomes a typed null."""
    raw = fixture(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("sequence"),
        F.col("user_id").alias("deviceId"),
        F.col("value").cast("string").alias("temperatureC"),
        F.when(F.col("event_type") == "view", "soon").otherwise(F.col("ts").cast("string")).alias("enqueuedTime"),
        F.when(F.col("event_type") == "click", F.col("ts")).alias("etlLoadTs"),
        F.get_json_object("props", "$.k").alias("units"),
        F.col("value").cast("string").alias("amount"),
        (F.col("event_id") % 2).cast("string").alias("flagged"),
    )
    spec = {"sequence": "bigint", "deviceId": "string", "temperatureC": "double", "enqueuedTime": "timestamp",
            "status": "string", "etlLoadTs": "timestamp", "units": "int", "amount": "decimal(10,2)",
            "flagged": "boolean"}
    return conform(raw, spec, defaults={"etlLoadTs": F.lit(LOAD_TIME)})


@register("""
SELECT o_orderkey, TIMESTAMP '2024-02-01' AS load_timestamp, 'orders.parquet' AS source_file,
       'sales.orders' AS _source_table_fqn, 'run-1' AS _run_id
FROM orders
""")
def shape_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and run lineage; the path is reduced to the table's name."""
    rows = with_file_lineage(fixture(spark, sf_dir, "orders"), LOAD_TIME)
    lined = with_run_lineage(rows, "sales.orders", "run-1", LOAD_TIME)
    table = F.regexp_extract("source_file", "/([^/]*[.]parquet)(/|$)", 1)
    return lined.select("o_orderkey", "load_timestamp", table.alias("source_file"), "_source_table_fqn", "_run_id")


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def dq_run_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's rows out of a bronze table that holds two."""
    path = scratch_path(spark, "bronze")
    orders = fixture(spark, sf_dir, "orders")
    early = orders.where("o_orderdate < '1998-01-01'")
    late = orders.where("o_orderdate >= '1998-01-01'")
    append_run(with_run_lineage(early, "sales.orders", "run-1", LOAD_TIME), path, "run-1")
    append_run(with_run_lineage(late, "sales.orders", "run-2", LOAD_TIME), path, "run-2")
    return scoped_to_run(read_run(spark, path, "run-2"), "run-2").select("o_orderkey", "o_totalprice")


@register("""
SELECT event_id, trim('  device-' || user_id || ' ') AS "deviceId", upper(trim(' ' || event_type || '  ')) AS status
FROM events
""")
def fn_normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = fixture(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("  device-"), "user_id", F.lit(" ")).alias("deviceId"),
        F.concat(F.lit(" "), "event_type", F.lit("  ")).alias("status"),
    )
    return normalized(padded, trims=["deviceId"], uppers=["status"])


@register("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS plain_time FROM events
""")
def fn_regex_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trailing Z is removed where there is one."""
    zulu = F.when(F.col("event_id") % 2 == 0, F.concat(iso_text("ts"), F.lit("Z"))).otherwise(iso_text("ts"))
    return fixture(spark, sf_dir, "events").select("event_id", without_zulu(zulu).alias("plain_time"))


@register(f"""
WITH d AS ({DEVICE_EVENTS_SQL}),
     k AS (SELECT * REPLACE (CASE WHEN sequence % 3 = 0 THEN NULL ELSE "offset" END AS "offset") FROM d)
SELECT sequenceNumber, {EVENT_ID_SQL} AS "eventId",
       CASE WHEN partitionId IS NOT NULL AND "offset" IS NOT NULL
            THEN sha256(concat_ws('||', 'eh', partitionId, "offset"))
            WHEN coalesce(deviceId, "timestamp", CAST(sequence AS VARCHAR)) IS NOT NULL
            THEN sha256('batch||' || coalesce(deviceId, chr(0)) || '||' || coalesce("timestamp", chr(0))
                        || '||' || coalesce(CAST(sequence AS VARCHAR), chr(0))) END AS "strictId"
FROM k
""")
def fn_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event identity by bus position, or by device, time and sequence."""
    missing = F.when(F.col("sequence") % 3 != 0, F.col("offset"))
    rows = device_events(spark, sf_dir).withColumn("offset", missing)
    return rows.select("sequenceNumber", event_id().alias("eventId"), event_id(strict=True).alias("strictId"))


@register("""
SELECT event_id,
       CASE event_id % 5 WHEN 0 THEN ts WHEN 1 THEN date_trunc('millisecond', ts)
            WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts) END AS parsed,
       CASE WHEN event_id % 5 = 1 THEN date_trunc('millisecond', ts) END AS by_pattern
FROM events
""")
def fn_parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time in four text forms and one junk form."""
    form = F.col("event_id") % 5
    text = (
        F.when(form == 0, F.concat(iso_text("ts"), F.lit("+00:00")))
        .when(form == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(form == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(form == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("yesterday")
    )
    return fixture(spark, sf_dir, "events").withColumn("text", text).select(
        "event_id", event_time("text").alias("parsed"),
        F.try_to_timestamp(without_zulu("text"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("by_pattern"),
    )


@register("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INTEGER) AS due_day,
       CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
       o_orderdate + INTERVAL 7 MINUTE AS shifted, o_orderdate >= TIMESTAMP '1998-01-01' AS is_late,
       CAST(o_orderdate AS DATE) = DATE '1997-05-28' AS is_day
FROM orders
""")
def fn_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return fixture(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("order_day"),
        F.date_add(day, (F.col("o_orderkey") % 365).cast("int")).alias("due_day"),
        F.month(day).alias("order_month"), F.date_trunc("month", day).alias("month_start"),
        F.expr("o_orderdate + INTERVAL 7 MINUTES").alias("shifted"),
        F.expr("o_orderdate >= TIMESTAMP('1998-01-01 00:00:00')").alias("is_late"),
        F.expr("to_date(o_orderdate) = DATE('1997-05-28')").alias("is_day"),
    )


@register("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (l_partkey - 1000) % 7 AS remainder, (((l_partkey - 1000) % 7) + 7) % 7 AS positive_modulo,
       round(l_extendedprice * (1 - l_discount) + l_tax, 4) AS net,
       l_extendedprice / l_quantity AS unit_price
FROM lineitem
""")
def fn_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.col("l_partkey") - 1000
    return fixture(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (shifted % 7).alias("remainder"), F.pmod(shifted, F.lit(7)).alias("positive_modulo"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_tax"), 4).alias("net"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


@register(f"""
SELECT o_orderkey, (ARRAY[{", ".join(f"'{r}'" for r in REGIONS)}])[CAST(o_orderkey % 4 + 1 AS INTEGER)] AS region,
       (ARRAY[{", ".join(f"'{t}'" for t in TIERS)}])[CAST(o_custkey % 4 + 1 AS INTEGER)] AS customer_tier
FROM orders
""")
def fn_array_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "orders").select(
        "o_orderkey", pick(REGIONS, F.col("o_orderkey")).alias("region"),
        pick(TIERS, F.col("o_custkey")).alias("customer_tier"),
    )
