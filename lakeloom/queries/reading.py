"""Queries over sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.functions.events import decode_envelope
from lakeloom.functions.shaping import conform, with_file_lineage, with_run_lineage
from lakeloom.operators import sinks
from lakeloom.queries.inputs import DECODED_SQL, LOAD_TIME, RUN_TIME, envelope
from lakeloom.queries.registry import register
from lakeloom.plans.incremental import IncrementalLoader
from lakeloom.session import scratch_path
from lakeloom.sources import ranges
from lakeloom.sources.files import (
    between_dates, file_stream, fixture, fixture_glob, persisted_schema, read_files, source_folder,
)
from lakeloom.sources.jdbc import FrameTable
from lakeloom.streaming.runs import append_batches, drain, drain_batches

# SQL of the repeatable draw in sources.ranges.
DRAW_SQL = "((((({key} + {salt}) % 2147483648) * 1103515245 + 12345) % 2147483648) >> 8) % {modulus}"


def _draw(key: str, modulus: int, salt: int = 0) -> str:
    return DRAW_SQL.format(key=key, salt=salt, modulus=modulus)


@register("""
SELECT event_id, ts, user_id, event_type, value, props,
       TIMESTAMP '2024-02-01 00:00:00' AS load_timestamp
FROM events
""")
def src_file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files into bronze as a stream, schema inferred once and stored."""
    state, out = scratch_path(spark, "state"), scratch_path(spark, "bronze")
    landing = fixture_glob(sf_dir, "events")
    schema = persisted_schema(spark, landing, "parquet", f"{state}/schema")
    stream = with_file_lineage(file_stream(spark, landing, schema), LOAD_TIME)
    drain(stream, out, f"{state}/checkpoint")
    return spark.read.parquet(out).drop("source_file")


@register("SELECT * FROM orders")
def src_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to a table, read as a stream."""
    path, out, state = (scratch_path(spark, part) for part in ("bronze", "silver", "state"))
    table = f"bronze_{path.rsplit('-', 1)[1]}"
    sinks.register_table(fixture(spark, sf_dir, "orders"), table, path)
    try:
        drain(spark.readStream.table(table), out, state)
    finally:
        sinks.drop_table(spark, table)
    return spark.read.parquet(out)


@register(DECODED_SQL)
def src_event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus messages: capped stream, JSON decoding, per-batch append."""
    landing, out, state = (scratch_path(spark, part) for part in ("bus", "bronze", "state"))
    messages = envelope(spark, sf_dir)
    sinks.land(messages.where(F.col("enqueuedTime") < "2024-01-16"), landing, "20240116_000000")
    sinks.land(messages.where(F.col("enqueuedTime") >= "2024-01-16"), landing, "20240131_000000")
    stream = file_stream(spark, f"{landing}/*", messages.schema, max_files_per_trigger=1)
    drain_batches(decode_envelope(stream, LOAD_TIME), state, append_batches(out))
    return spark.read.parquet(out).drop("batch_id")


_FORMATS_SPEC = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
                 "value": "double", "region": "string"}


@register("""
SELECT f.file_format, event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS region
FROM events, (VALUES ('parquet'), ('json'), ('csv')) AS f(file_format)
""")
def src_multi_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows read back from Parquet, JSON and CSV and conformed."""
    base = scratch_path(spark, "formats")
    events = fixture(spark, sf_dir, "events")
    merged = None
    for file_format in ("parquet", "json", "csv"):
        sinks.write_files(events, f"{base}/{file_format}", file_format)
        declared = events.schema if file_format == "json" else None
        rows = conform(read_files(spark, f"{base}/{file_format}", file_format, schema=declared), _FORMATS_SPEC)
        rows = rows.withColumn("file_format", F.lit(file_format))
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


WAYS = ("desk", "post", "agent")


@register(f"""
SELECT id % 1201 + 7 AS seller_id, DATE '2019-03-04' + CAST(id % 271 AS INTEGER) AS sold_on,
       ({_draw('id', 7919)}) / 64.0::DOUBLE AS price, CAST(({_draw('id', 11, 3)}) + 2 AS INTEGER) AS pieces,
       CASE id % 3 WHEN 0 THEN '{WAYS[0]}' WHEN 1 THEN '{WAYS[1]}' ELSE '{WAYS[2]}' END AS way
FROM (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem)
""")
def src_range_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A computed sales table, a row for each line's key."""
    ids = fixture(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    return ranges.computed(ids, {
        "seller_id": ranges.cycle(1201, first=7), "sold_on": ranges.days("2019-03-04", 271),
        "price": ranges.drawn(7919, "double", per=64.0), "pieces": ranges.drawn(11, "int", first=2, salt=3),
        "way": ranges.cases(WAYS)})


@register("""
SELECT * FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-05-01 00:00:00' AND TIMESTAMP '1997-06-06 00:00:00'
""")
def src_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return between_dates(fixture(spark, sf_dir, "orders"), "o_orderdate", datetime(1997, 5, 1), datetime(1997, 6, 6))


@register("""
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '20240101_080000' ELSE '20240102_080000' END AS run_stamp
FROM orders
""")
def sink_landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs land in folders of their own."""
    base = scratch_path(spark, "landing")
    orders = fixture(spark, sf_dir, "orders")
    sinks.land(orders.where("o_orderdate < '1998-01-01'"), base, "20240101_080000", "orders")
    sinks.land(orders.where("o_orderdate >= '1998-01-01'"), base, "20240102_080000", "orders")
    stamp = source_folder("/orders_([0-9]{8}_[0-9]{6})/")
    return spark.read.parquet(f"{base}/*").select("o_orderkey", "o_totalprice", stamp.alias("run_stamp"))


@register("""
SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '20240101_080000' ELSE '20240102_080000' END AS file_date,
       count(*) AS row_count, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1
""")
def sink_landing_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing folders whose date is discovered as a partition column."""
    base = scratch_path(spark, "landing")
    orders = fixture(spark, sf_dir, "orders")
    sinks.land_dated(orders.where("o_orderdate < '1998-01-01'"), base, "20240101_080000")
    sinks.land_dated(orders.where("o_orderdate >= '1998-01-01'"), base, "20240102_080000")
    return spark.read.parquet(base).groupBy("file_date").agg(
        F.count("*").alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


@register("""
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def sink_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second append brings a new column."""
    path = scratch_path(spark, "evolving")
    orders = fixture(spark, sf_dir, "orders")
    sinks.append_evolving(orders.where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_totalprice"), path)
    sinks.append_evolving(
        orders.where("o_orderdate >= '1998-01-01'").select("o_orderkey", "o_totalprice", "o_orderpriority"), path
    )
    return sinks.read_evolving(spark, path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@register("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderstatus END AS o_orderstatus
FROM orders
""")
def sink_merge_schema_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder written before schemas were kept; two appends bring a column each, the
    second in another order."""
    path = scratch_path(spark, "legacy")
    orders = fixture(spark, sf_dir, "orders")
    orders.where("o_orderdate < '1996-01-01'").select("o_orderkey", "o_totalprice").write.parquet(path)
    middle = orders.where("o_orderdate >= '1996-01-01' AND o_orderdate < '1998-01-01'")
    sinks.append_evolving(middle.select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    late = orders.where("o_orderdate >= '1998-01-01'")
    sinks.append_evolving(late.select("o_orderstatus", "o_orderkey", "o_orderpriority", "o_totalprice"), path)
    return sinks.read_evolving(spark, path)


@register(f"""
SELECT o_orderkey AS payment_id, DATE '2021-06-15' + CAST(o_orderkey % 433 AS INTEGER) AS paid_on,
       o_orderkey % 97 AS desk_id, CAST(({_draw('o_orderkey', 9973)}) / 100.0 AS DECIMAL(10,2)) AS amount
FROM orders
""")
def sink_insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared table whose first content is replaced."""
    path = scratch_path(spark, "payments")
    table = f"payments_{path.rsplit('-', 1)[1]}"
    rows = ranges.computed(fixture(spark, sf_dir, "orders"), {
        "payment_id": lambda key: key, "paid_on": ranges.days("2021-06-15", 433), "desk_id": ranges.cycle(97),
        "amount": ranges.drawn(9973, "decimal(10,2)", per=100.0)}, key="o_orderkey")
    sinks.create_table(spark, table, "payment_id BIGINT, paid_on DATE, desk_id BIGINT, amount DECIMAL(10,2)", path)
    try:
        sinks.insert_overwrite(rows.withColumn("amount", F.col("amount") * 0), table)
        sinks.insert_overwrite(rows, table)
    finally:
        sinks.drop_table(spark, table)
    return spark.read.parquet(path)


@register("""
SELECT 'Silver orders (deduped)' AS table_comment, 'silver' AS quality, count(*) AS row_count FROM orders
""")
def sink_table_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and properties of a table, with its row count."""
    path = scratch_path(spark, "silver")
    table = f"silver_{path.rsplit('-', 1)[1]}"
    orders = fixture(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sinks.create_table(spark, table, "o_orderkey BIGINT, o_totalprice DOUBLE", path,
                       comment="Silver orders (deduped)", properties={"quality": "silver"})
    try:
        sinks.insert_overwrite(orders, table)
        comment = sinks.table_comment(spark, table)
        quality = sinks.table_properties(spark, table)["quality"]
    finally:
        sinks.drop_table(spark, table)
    return spark.read.parquet(path).agg(F.count("*").alias("row_count")).select(
        F.lit(comment).alias("table_comment"), F.lit(quality).alias("quality"), "row_count"
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> IncrementalLoader:
    """Two runs over orders: the source as of 1999, then as of today, with a
    lookback of ten days."""
    loader = IncrementalLoader(spark, scratch_path(spark, "control"), scratch_path(spark, "bronze"))
    loader.configure([
        ("sales", "orders", "sales.orders", "o_orderdate", "incremental", True, None, "bronze", "orders",
         14_400, LOAD_TIME, LOAD_TIME),
        ("sales", "returns", "sales.returns", "o_orderdate", "incremental", False, None, "bronze", "returns",
         0, LOAD_TIME, LOAD_TIME),
    ], LOAD_TIME)
    orders = fixture(spark, sf_dir, "orders")
    as_of_1999 = FrameTable(orders.where("o_orderdate < '2000-01-01'"))
    loader.run({"sales.orders": as_of_1999}, "run-1", LOAD_TIME)
    loader.run({"sales.orders": FrameTable(orders)}, "run-2", RUN_TIME)
    return loader


@register("""
WITH first_run AS (SELECT max(o_orderdate) AS high FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT *, TIMESTAMP '2024-02-01' AS _ingest_ts, 'sales.orders' AS _source_table_fqn, 'run-1' AS _run_id
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL
SELECT orders.*, TIMESTAMP '2024-02-02', 'sales.orders', 'run-2'
FROM orders, first_run WHERE o_orderdate > high - INTERVAL 14400 MINUTE
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows after two incremental runs."""
    loader = _two_loads(spark, sf_dir)
    return spark.read.parquet(loader.bronze("bronze", "orders"))


@register("""
WITH first_run AS (SELECT max(o_orderdate) AS high FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT 'sales.orders' AS source_table_fqn, 'o_orderdate' AS watermark_column,
       max(o_orderdate) AS last_successful_watermark, max(o_orderdate) AS current_batch_max_watermark,
       'run-2' AS last_run_id, TIMESTAMP '2024-02-02' AS last_run_ts,
       count(*) FILTER (o_orderdate > high - INTERVAL 14400 MINUTE) AS last_row_count,
       'SUCCESS' AS status, TIMESTAMP '2024-02-02' AS updated_at
FROM orders, first_run
""")
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control state after two incremental runs; a disabled source has none."""
    return _two_loads(spark, sf_dir).watermarks.rows()


@register("SELECT 'sales.events' AS source, count(*) AS row_count FROM events")
def shape_observe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of a write, observed while writing."""
    rows = with_run_lineage(fixture(spark, sf_dir, "events"), "sales.events", "run-1", LOAD_TIME)
    count = sinks.append_run(rows, scratch_path(spark, "bronze"), "run-1")
    return spark.createDataFrame([("sales.events", count)], "source string, row_count bigint")


@register("""
SELECT CAST(count(*) AS BIGINT) AS row_count, count(DISTINCT event_id) AS distinct_events FROM events
""")
def stream_foreach_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch append, replayed once as after a crash: nothing is doubled."""
    out, state = scratch_path(spark, "bronze"), scratch_path(spark, "state")
    events = fixture(spark, sf_dir, "events")
    handle = append_batches(out)

    def twice(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        handle(batch, batch_id)

    drain_batches(file_stream(spark, fixture_glob(sf_dir, "events"), events.schema), state, twice)
    return spark.read.parquet(out).agg(
        F.count("*").alias("row_count"), F.count_distinct("event_id").alias("distinct_events")
    )
