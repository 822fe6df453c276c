"""Queries over upserts, control tables and the unified event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.sinks import land
from lakeloom.operators.upsert import KeyedTable, insert_absent, replace_listed, set_where
from lakeloom.plans.incremental import BEGINNING, NEVER_RAN, SUCCESS
from lakeloom.plans.unify import load_batch, load_stream
from lakeloom.queries.inputs import (
    BATCH_FILES_SQL, DECODED_SQL, EVENT_ID_SQL, LOAD_TIME, RUN_TIME, batch_files, buckets_for, envelope,
)
from lakeloom.queries.registry import register
from lakeloom.session import scratch_path
from lakeloom.sources.files import file_stream, fixture


def _orders_upserted(spark: SparkSession, sf_dir: str):
    """Orders before 1998 stored; orders from 1997 on arrive with a raised price."""
    orders = fixture(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_path(spark, "keyed"))
    table.create(orders.where("o_orderdate < '1998-01-01'"), ["o_orderkey"], buckets_for(spark, sf_dir, "orders"))
    arriving = orders.where("o_orderdate >= '1997-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    return table, table.upsert(arriving, newest=["o_orderdate"])


@register("""
SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice + 1000
                       ELSE o_totalprice END AS o_totalprice)
FROM orders
""")
def upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_upserted(spark, sf_dir)[0].rows()


@register("""
SELECT count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01') AS source_rows,
       count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS inserted,
       count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01') AS updated,
       count(*) FILTER (o_orderdate < TIMESTAMP '1997-01-01') AS copied, CAST(0 AS BIGINT) AS deleted,
       count(*) AS output_rows
FROM orders
""")
def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _orders_upserted(spark, sf_dir)[1].as_dict()
    return spark.createDataFrame([metrics], ", ".join(f"{name} bigint" for name in metrics))


@register("""
SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice + 1000
                       ELSE o_totalprice END AS o_totalprice), TRUE AS more_buckets
FROM orders
""")
def upsert_grow_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets of a table are split eightfold between two upserts."""
    orders = fixture(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_path(spark, "keyed"))
    table.create(orders.where("o_orderdate < '1998-01-01'"), ["o_orderkey"], 8)
    table.upsert(orders.where("o_orderdate >= '1999-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1000))
    table.grow(64)
    between = orders.where("o_orderdate >= '1997-01-01' AND o_orderdate < '1999-01-01'")
    table.upsert(between.withColumn("o_totalprice", F.col("o_totalprice") + 1000))
    return table.rows().withColumn("more_buckets", F.lit(table.buckets == 64))


@register("""
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert brings a column that the table lacks."""
    orders = fixture(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_path(spark, "keyed"))
    table.create(orders.where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_totalprice"), ["o_orderkey"],
                 buckets_for(spark, sf_dir, "orders"))
    arriving = orders.where("o_orderdate >= '1997-01-01'").select("o_orderkey", "o_totalprice", "o_orderpriority")
    table.upsert(arriving, evolve=True)
    return table.rows()


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load setting per customer, as if each were a source of its own."""
    return fixture(spark, sf_dir, "customer").select(
        F.col("c_name").alias("source_table_fqn"), F.lit("o_orderdate").alias("watermark_column"),
        (F.col("c_acctbal") > 0).alias("enabled"), F.col("c_nationkey").alias("lookback_minutes"),
        F.lit(LOAD_TIME).cast("timestamp").alias("updated_at"),
    )


SETTINGS_SQL = """
  SELECT c_name AS source_table_fqn, 'o_orderdate' AS watermark_column, c_acctbal > 0 AS enabled,
         c_nationkey AS lookback_minutes, TIMESTAMP '2024-02-01' AS updated_at
  FROM customer
"""
_LISTED = ["Customer#000000001", "Customer#000000007", "Customer#000000042"]


@register(f"""
WITH s AS ({SETTINGS_SQL})
SELECT * FROM s WHERE source_table_fqn NOT IN ({", ".join(f"'{name}'" for name in _LISTED)})
UNION ALL SELECT name, 'o_orderdate', TRUE, CAST(10 AS INTEGER), TIMESTAMP '2024-02-02'
FROM (VALUES {", ".join(f"('{name}')" for name in _LISTED)}) AS v(name)
""")
def ctl_metadata_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed settings are deleted and inserted anew."""
    settings = _settings(spark, sf_dir)
    values = [(name, "o_orderdate", True, 10, RUN_TIME) for name in _LISTED]
    return replace_listed(settings, "source_table_fqn", _LISTED, spark.createDataFrame(values, settings.schema))


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks of customers that ordered before 1996."""
    names = fixture(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    reached = (
        fixture(spark, sf_dir, "orders").where("o_orderdate < '1996-01-01'")
        .groupBy("o_custkey").agg(F.max("o_orderdate").alias("high"))
    )
    return reached.join(names, "o_custkey").select(
        F.col("c_name").alias("source_table_fqn"), F.col("high").cast("timestamp").alias("last_successful_watermark"),
        F.lit(SUCCESS).alias("status"),
    )


@register(f"""
WITH s AS ({SETTINGS_SQL}), progress AS (
  SELECT c_name AS source_table_fqn, max(o_orderdate) AS last_successful_watermark, 'SUCCESS' AS status
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY c_name)
SELECT * FROM progress
UNION ALL SELECT source_table_fqn, TIMESTAMP '1900-01-01', 'NEVER_RAN' FROM s
WHERE enabled AND source_table_fqn NOT IN (SELECT source_table_fqn FROM progress)
""")
def ctl_watermark_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enabled sources without a watermark get the first one."""
    seeds = _settings(spark, sf_dir).where("enabled").select(
        "source_table_fqn", F.lit(BEGINNING).cast("timestamp").alias("last_successful_watermark"),
        F.lit(NEVER_RAN).alias("status"),
    )
    return insert_absent(_progress(spark, sf_dir), seeds, ["source_table_fqn"])


@register("""
WITH o AS (
  SELECT c_custkey, max(o_orderdate) AS high, count(*) FILTER (o_orderdate > TIMESTAMP '2001-01-01') AS fresh
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT c_custkey AS source_key,
       CASE WHEN high IS NULL THEN TIMESTAMP '2001-01-01' ELSE high END AS last_successful_watermark,
       high AS current_batch_max_watermark, fresh AS last_row_count, 'run-2' AS last_run_id, 'SUCCESS' AS status
FROM o
""")
def ctl_watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three outcomes of a run applied to each source's control row: empty
    source, nothing new, new rows."""
    last = F.lit("2001-01-01").cast("timestamp_ntz")
    seen = fixture(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("source_key")).agg(
        F.max("o_orderdate").alias("high"), F.count_if(F.col("o_orderdate") > last).alias("fresh")
    )
    state = fixture(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("source_key"), last.alias("last_successful_watermark"),
        last.alias("current_batch_max_watermark"), F.lit(None).cast("bigint").alias("last_row_count"),
        F.lit("run-1").alias("last_run_id"), F.lit(NEVER_RAN).alias("status"),
    )
    rows = state.join(seen, "source_key", "left")
    ran = {"last_run_id": F.lit("run-2"), "status": F.lit(SUCCESS)}
    empty = F.col("high").isNull()
    rows = set_where(rows, empty, {**ran, "current_batch_max_watermark": F.lit(None), "last_row_count": F.lit(0)})
    advanced = {**ran, "current_batch_max_watermark": F.col("high"), "last_successful_watermark": F.col("high")}
    rows = set_where(rows, ~empty & (F.col("fresh") == 0), {**advanced, "last_row_count": F.lit(0)})
    rows = set_where(rows, ~empty & (F.col("fresh") > 0), {**advanced, "last_row_count": F.col("fresh")})
    return rows.drop("high", "fresh")


_UNIFIED_COLUMNS = (
    '"eventId", "timestamp", sequence, "deviceId", "temperatureC", status, "enqueuedTime", "offset", "sequenceNumber", '
    '"partitionId", "etlLoadTs"'
)


def _identified(inner: str) -> str:
    return f'SELECT {EVENT_ID_SQL} AS "eventId", * FROM ({inner})'


@register(f"SELECT {_UNIFIED_COLUMNS} FROM ({_identified(BATCH_FILES_SQL)})")
def unify_batch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files twice: the first run creates the table, the second merges
    overlapping and new rows."""
    path = scratch_path(spark, "unified")
    rows, buckets = batch_files(spark, sf_dir), buckets_for(spark, sf_dir, "events")
    load_batch(spark, rows.where("timestamp < '2024-01-20'"), path, buckets, moment=LOAD_TIME)
    load_batch(spark, rows.where("timestamp >= '2024-01-10'"), path, buckets, moment=LOAD_TIME)
    return KeyedTable(spark, path).rows()


@register(f"""
SELECT {_UNIFIED_COLUMNS} FROM ({_identified(BATCH_FILES_SQL)})
UNION ALL SELECT {_UNIFIED_COLUMNS} FROM (
  {_identified(BATCH_FILES_SQL)}) WHERE "timestamp" >= '2024-01-10' AND "timestamp" < '2024-01-20'
""")
def unify_batch_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs in append mode keep the overlap twice."""
    path = scratch_path(spark, "unified")
    rows, buckets = batch_files(spark, sf_dir), buckets_for(spark, sf_dir, "events")
    load_batch(spark, rows.where("timestamp < '2024-01-20'"), path, buckets, moment=LOAD_TIME)
    load_batch(spark, rows.where("timestamp >= '2024-01-10'"), path, buckets, mode="append", moment=LOAD_TIME)
    return KeyedTable(spark, path).rows()


def _streamed(spark: SparkSession, sf_dir: str, path: str, metrics: str | None = None) -> None:
    """Two stream runs; the second replays part of the first one's messages with
    a later arrival time."""
    bus, state = scratch_path(spark, "bus"), scratch_path(spark, "state")
    messages, buckets = envelope(spark, sf_dir), buckets_for(spark, sf_dir, "events")
    replayed = messages.withColumn("enqueuedTime", F.col("enqueuedTime") + F.expr("INTERVAL 1 HOUR"))
    for run, part in enumerate((
        messages.where("enqueuedTime < '2024-01-20'"), replayed.where("enqueuedTime >= '2024-01-10 01:00:00'"),
    )):
        land(part, bus, f"2024020{run + 1}_000000")
        stream = file_stream(spark, f"{bus}/*", messages.schema, max_files_per_trigger=100)
        load_stream(stream, path, state, buckets, metrics, LOAD_TIME)


@register(f"""
SELECT * REPLACE (CASE WHEN "enqueuedTime" >= TIMESTAMP '2024-01-10'
                       THEN "enqueuedTime" + INTERVAL 1 HOUR ELSE "enqueuedTime" END AS "enqueuedTime")
FROM ({_identified(DECODED_SQL)})
""")
def unify_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches upserted into a keyed table; replayed messages update."""
    path = scratch_path(spark, "unified")
    _streamed(spark, sf_dir, path)
    return KeyedTable(spark, path).rows()


@register("""
SELECT count(*) + count(*) FILTER (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') AS source_rows,
       count(*) AS inserted, count(*) FILTER (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') AS updated
FROM events
""")
def unify_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert metrics stored per micro-batch, summed."""
    path, metrics = scratch_path(spark, "unified"), scratch_path(spark, "metrics")
    _streamed(spark, sf_dir, path, metrics)
    stored = spark.read.parquet(metrics)
    return stored.agg(*[F.sum(name).alias(name) for name in ("source_rows", "inserted", "updated")])


@register(f"""
SELECT {_UNIFIED_COLUMNS} FROM ({_identified(BATCH_FILES_SQL)})
UNION ALL SELECT {_UNIFIED_COLUMNS} FROM (
  SELECT * REPLACE (CASE WHEN "enqueuedTime" >= TIMESTAMP '2024-01-10'
                         THEN "enqueuedTime" + INTERVAL 1 HOUR ELSE "enqueuedTime" END AS "enqueuedTime")
  FROM ({_identified(DECODED_SQL)}))
""")
def unify_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes into one table; without a bus position in the batch files the
    same event gets one identity per route."""
    path = scratch_path(spark, "unified")
    load_batch(spark, batch_files(spark, sf_dir), path, buckets_for(spark, sf_dir, "events"), moment=LOAD_TIME)
    _streamed(spark, sf_dir, path)
    return KeyedTable(spark, path).rows()
