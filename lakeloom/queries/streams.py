"""Queries over watermarked deduplication, resumption, rate caps and chains."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators.sinks import drop_table, land
from lakeloom.operators.upsert import KeyedTable
from lakeloom.plans.medallion import ingest_files, refine_table, serve_top
from lakeloom.queries.inputs import LOAD_TIME, buckets_for
from lakeloom.queries.registry import register
from lakeloom.session import scratch_path
from lakeloom.sources.files import file_stream, fixture, fixture_glob
from lakeloom.streaming.dedup import dedup_by_event_time, dedup_by_key, dedup_within_watermark
from lakeloom.streaming.memory import dedup_batches
from lakeloom.streaming.runs import append_batches, drain, drain_batches, state_settings, stored_late_rows, upsert_batches


def _fixture_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return file_stream(spark, fixture_glob(sf_dir, name), fixture(spark, sf_dir, name).schema)


def _drained(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> DataFrame:
    out, state = scratch_path(spark, "silver"), scratch_path(spark, "state")
    drain(rows, out, state, state_settings(spark, fixture_glob(sf_dir, name)))
    return spark.read.parquet(out)


@register("SELECT DISTINCT l_returnflag, l_suppkey, l_linestatus, l_shipdate FROM lineitem")
def stream_dedup_evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-like rows, one per vendor, places and event time."""
    keys = ["l_returnflag", "l_suppkey", "l_linestatus"]
    rows = _fixture_stream(spark, sf_dir, "lineitem").select(*keys, "l_shipdate")
    return _drained(spark, sf_dir, "lineitem", dedup_by_event_time(rows, keys, "l_shipdate"))


@register("SELECT * FROM events")
def stream_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key for all time; every event lands three times, twice in one run."""
    landing, out, state = (scratch_path(spark, part) for part in ("landing", "silver", "state"))
    events = fixture(spark, sf_dir, "events")
    settings = state_settings(spark, fixture_glob(sf_dir, "events"))
    for run, copies in enumerate((events.unionAll(events), events)):
        land(copies, landing, f"2024020{run + 1}_000000")
        stream = file_stream(spark, f"{landing}/*", events.schema)
        drain(dedup_by_key(stream, ["event_id"], "ts", delay="60 days"), out, state, settings)
    return spark.read.parquet(out)


@register("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key within the watermark delay, here longer than the data."""
    keys = ["user_id", "event_type"]
    rows = dedup_within_watermark(_fixture_stream(spark, sf_dir, "events"), keys, "ts", delay="60 days")
    return _drained(spark, sf_dir, "events", rows).select(*keys)


@register("""
SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY user_id, event_type
""")
def stream_latest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per key kept across runs; the older half arrives last."""
    landing, path, state = (scratch_path(spark, part) for part in ("landing", "silver", "state"))
    events = fixture(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    handle = upsert_batches(path, ["user_id", "event_type"], buckets_for(spark, sf_dir, "events"),
                            newest=["ts"], tie_breaks=["value"], only_newer=True)
    for run, part in enumerate(("ts >= '2024-01-15'", "ts < '2024-01-15'")):
        land(events.where(part), landing, f"2024020{run + 1}_000000")
        drain_batches(file_stream(spark, f"{landing}/*", events.schema), state, handle)
    return KeyedTable(spark, path).rows()


@register("""
WITH mark AS (SELECT max(ts) - INTERVAL 15 DAY AS watermark FROM events)
SELECT count(*) FILTER (ts >= watermark) AS kept, 3 * count(*) FILTER (ts < watermark) AS late
FROM events, mark
""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land after the watermark has passed them are dropped and counted,
    each of three copies."""
    landing, out, state = (scratch_path(spark, part) for part in ("landing", "silver", "state"))
    events = fixture(spark, sf_dir, "events")
    settings = state_settings(spark, fixture_glob(sf_dir, "events"))
    for run, part in enumerate(("ts >= '2024-01-20'", "ts >= '2024-01-10' AND ts < '2024-01-20'", "ts < '2024-01-10'")):
        rows = events.where(part)
        land(rows.unionAll(rows).unionAll(rows), landing, f"2024020{run + 1}_000000")
        stream = file_stream(spark, f"{landing}/*", events.schema)
        drain(dedup_by_event_time(stream, ["user_id", "event_type", "event_id"], "ts", delay="15 days"), out, state, settings)
    kept = spark.read.parquet(out).agg(F.count("*").alias("kept"))
    late = stored_late_rows(spark, state).agg(F.coalesce(F.sum("late"), F.lit(0)).alias("late"))
    return kept.join(late)


_HOT_SQL = "CASE WHEN event_id % 2 = 0 THEN 0 ELSE user_id END"


@register(f"""
WITH e AS (SELECT {_HOT_SQL} AS sensor, date_trunc('hour', ts) AS hour FROM events),
mark AS (SELECT max(hour) - INTERVAL 15 DAY AS watermark FROM e)
SELECT sensor, hour, CAST(NULL AS BIGINT) AS late FROM e, mark WHERE hour >= watermark GROUP BY sensor, hour
UNION ALL SELECT NULL, NULL, 2 * count(*) FILTER (hour < watermark) FROM e, mark
""")
def stream_dedup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key and hour where one key holds half of the rows; runs overlap,
    and the last one brings only late rows, twice."""
    landing, out, memory, state = (scratch_path(spark, part) for part in ("landing", "silver", "memory", "state"))
    events = fixture(spark, sf_dir, "events").select(
        F.expr(_HOT_SQL).alias("sensor"), F.date_trunc("hour", "ts").alias("hour"))
    handle = dedup_batches(out, memory, ["sensor"], "hour", timedelta(days=15))
    top = events.agg(F.max("hour").alias("top"))
    marked = events.join(F.broadcast(top)).withColumn("is_late", F.expr("hour < top - INTERVAL 15 DAY"))  # one row
    fresh, late = (marked.where(test).select("sensor", "hour") for test in ("NOT is_late", "is_late"))
    for run, part in enumerate((fresh, fresh.unionAll(fresh), late.unionAll(late))):
        land(part, landing, f"2024020{run + 1}_000000")
        drain_batches(file_stream(spark, f"{landing}/*", events.schema), state, handle)
    rows = spark.read.parquet(out).select("sensor", "hour", F.lit(None).cast("bigint").alias("late"))
    counts = spark.read.parquet(f"{memory}/batches").agg(F.sum("late").alias("late"))
    return rows.unionByName(counts, allowMissingColumns=True)


@register("SELECT * FROM events")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, run, land, run, run: every landed file is taken exactly once."""
    landing, out, state = (scratch_path(spark, part) for part in ("landing", "bronze", "state"))
    events = fixture(spark, sf_dir, "events")
    parts = ("ts < '2024-01-15'", "ts >= '2024-01-15'", None)
    for run, part in enumerate(parts):
        if part:
            land(events.where(part), landing, f"2024020{run + 1}_000000")
        drain(file_stream(spark, f"{landing}/*", events.schema), out, state)
    return spark.read.parquet(out)


@register("SELECT event_type, count(*) AS row_count, TRUE AS several_batches FROM events GROUP BY event_type")
def stream_rate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per micro-batch, so the landed files take several batches."""
    landing, out, state = (scratch_path(spark, part) for part in ("landing", "bronze", "state"))
    events = fixture(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    for run, part in enumerate(("ts < '2024-01-15'", "ts >= '2024-01-15'")):
        land(events.where(part), landing, f"2024020{run + 1}_000000")
    sizes: dict[int, int] = {}
    stream = file_stream(spark, f"{landing}/*", events.schema, max_files_per_trigger=1)
    drain_batches(stream, state, append_batches(out, log=sizes.__setitem__))
    counts = spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("row_count"))
    return counts.withColumn("several_batches", F.lit(len(sizes) > 1))


@register("""
SELECT o_custkey, count(*) AS trip_count
FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderdate FROM orders)
GROUP BY o_custkey ORDER BY trip_count DESC, o_custkey LIMIT 20
""")
def files_to_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to bronze, to deduplicated silver, to a top-20 view; run
    twice, the second run finds nothing new."""
    bronze_path, silver, state = (scratch_path(spark, part) for part in ("bronze", "silver", "state"))
    table = f"bronze_{bronze_path.rsplit('-', 1)[1]}"
    try:
        for _ in range(2):
            ingest_files(spark, fixture_glob(sf_dir, "orders"), f"{state}/bronze", table, bronze_path, LOAD_TIME)
            refine_table(spark, table, bronze_path, silver, f"{state}/silver",
                         ["o_custkey", "o_orderstatus"], "o_orderdate")
    finally:
        drop_table(spark, table)
    return serve_top(spark, silver, "vw_top_customers_stream", "o_custkey", 20, "trip_count")
