"""Queries over joins, aggregates, top-k reports and views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators import aggregates as agg, skew
from lakeloom.operators.layout import cached
from lakeloom.queries.registry import register
from lakeloom.session import ADAPTIVE_OFF, conf_scope, scratch_path
from lakeloom.sources.files import fixture

STAR_SQL = """
SELECT l_returnflag AS region, l_linestatus AS product_category, c_mktsegment AS customer_tier,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS event_month,
       count(*) AS row_cnt, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY ALL
"""


@register(STAR_SQL)
def join_star_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its customers' segments, grouped by four keys."""
    lines = fixture(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice")
    orders = fixture(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = fixture(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sums = agg.star_join_sums(
        lines.join(orders, "o_orderkey"), customers, "c_custkey",
        keys={"region": F.col("l_returnflag"), "product_category": F.col("l_linestatus"),
              "customer_tier": F.col("c_mktsegment"), "event_month": F.date_trunc("month", "l_shipdate")},
        sums={"revenue": F.col("l_extendedprice")},
    )
    return sums.withColumn("revenue", F.round("revenue", 2))


@register("SELECT max(o_orderkey) AS max_o_orderkey, max(o_custkey) AS max_o_custkey FROM orders")
def agg_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.maxima(fixture(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"])


@register("""
SELECT round(sum(l_extendedprice), 2) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-06-08'
""")
def agg_filtered_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    start, end = (F.lit(day).cast("timestamp_ntz") for day in (date(1998, 6, 1), date(1998, 6, 8)))
    week = (shipped >= start) & (shipped < end)
    total = agg.filtered_sum(fixture(spark, sf_dir, "lineitem"), week, F.col("l_extendedprice"), "revenue")
    return total.select(F.round("revenue", 2).alias("revenue"))


@register("""
SELECT l_shipdate AS event_date, round(sum(l_extendedprice), 2) AS revenue, sum(l_quantity) AS units
FROM lineitem
WHERE l_suppkey = 42 AND l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31'
GROUP BY l_shipdate
""")
def agg_point_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    start, end = (F.lit(day).cast("timestamp_ntz") for day in (date(1997, 1, 1), date(1999, 12, 31)))
    sums = agg.grouped_sums(
        fixture(spark, sf_dir, "lineitem"), {"event_date": shipped},
        {"revenue": F.col("l_extendedprice"), "units": F.col("l_quantity")},
        condition=(F.col("l_suppkey") == 42) & shipped.between(start, end),
    )
    return sums.withColumn("revenue", F.round("revenue", 2)).orderBy("event_date")


WIDE_FILTER = (
    "l_shipdate >= TIMESTAMP_NTZ '1997-01-01' AND l_shipdate < TIMESTAMP_NTZ '2000-10-01' "
    "AND l_linenumber IN (1, 2, 3, 4, 5)"
)


@register("""
SELECT l_linenumber AS region_id, l_returnflag AS channel_id,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS sale_month, count(*) AS orders,
       sum(l_quantity) AS units, round(sum(l_quantity * l_extendedprice), 2) AS revenue
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '2000-10-01'
  AND l_linenumber IN (1, 2, 3, 4, 5)
GROUP BY ALL
""")
def agg_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = agg.grouped_sums(
        fixture(spark, sf_dir, "lineitem"),
        {"region_id": F.col("l_linenumber"), "channel_id": F.col("l_returnflag"),
         "sale_month": F.date_trunc("month", "l_shipdate")},
        {"units": F.col("l_quantity"), "revenue": F.col("l_quantity") * F.col("l_extendedprice")},
        condition=F.expr(WIDE_FILTER), count_as="orders",
    )
    return sums.withColumn("revenue", F.round("revenue", 2)).orderBy(F.desc("revenue"))


@register("""
SELECT l_linenumber AS region_id, l_returnflag AS channel_id,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS sale_month, count(*) AS orders,
       sum(l_quantity) AS units, round(sum(l_quantity * l_extendedprice), 2) AS revenue,
       count(DISTINCT l_partkey) AS parts, TRUE AS estimate_within_bound
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '2000-10-01'
  AND l_linenumber IN (1, 2, 3, 4, 5)
GROUP BY ALL
""")
def agg_wide_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report with estimated distinct parts, checked against the exact
    count: off by at most four standard errors."""
    error = 0.05
    sums = agg.grouped_sums(
        fixture(spark, sf_dir, "lineitem"),
        {"region_id": F.col("l_linenumber"), "channel_id": F.col("l_returnflag"),
         "sale_month": F.date_trunc("month", "l_shipdate")},
        {"units": F.col("l_quantity"), "revenue": F.col("l_quantity") * F.col("l_extendedprice")},
        condition=F.expr(WIDE_FILTER), count_as="orders",
        more={"parts": F.count_distinct("l_partkey"), "estimate": F.approx_count_distinct("l_partkey", error)},
    )
    near = F.abs(F.col("estimate") - F.col("parts")) <= 4 * error * F.col("parts") + 1
    return sums.withColumns({"revenue": F.round("revenue", 2), "estimate_within_bound": near}).drop("estimate")


@register()
def agg_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated distinct parts; the estimate differs between engines."""
    return agg.distinct_estimate(fixture(spark, sf_dir, "lineitem"), ["l_linenumber", "l_returnflag"], "l_partkey")


@register("""
SELECT l_linenumber, l_returnflag, count(DISTINCT l_partkey) AS parts, TRUE AS within_bound, TRUE AS same_by_month
FROM lineitem GROUP BY ALL
""")
def agg_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts from stored sketches of each day; later days are added to the
    store. Merged by day or by month first, the estimate is the same, and within four
    standard errors of the exact count."""
    store, groups = scratch_path(spark, "sketches"), ["l_linenumber", "l_returnflag"]
    lines = fixture(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    for part in ("l_shipdate < '1999-01-01'", "l_shipdate >= '1999-01-01'"):
        agg.distinct_sketches(lines.where(part), [*groups, "day"], "l_partkey").write.mode("append").parquet(store)
    days = spark.read.parquet(store)
    months = agg.merged_sketches(days.withColumn("month", F.trunc("day", "month")), [*groups, "month"], "l_partkey")
    estimate = agg.sketched_distinct(days, groups, "l_partkey")
    by_month = agg.sketched_distinct(months, groups, "l_partkey").withColumnRenamed("approx_l_partkey", "by_month")
    exact = lines.groupBy(*groups).agg(F.count_distinct("l_partkey").alias("parts"))
    near = F.abs(F.col("approx_l_partkey") - F.col("parts")) <= 4 * 0.01625 * F.col("parts") + 1
    return exact.join(estimate, groups).join(by_month, groups).select(
        *groups, "parts", near.alias("within_bound"), (F.col("approx_l_partkey") == F.col("by_month")).alias("same_by_month"))


@register("""
WITH o AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey END AS c_custkey, o_totalprice FROM orders)
SELECT c_nationkey, count(*) AS row_cnt, round(sum(o_totalprice), 2) AS revenue, TRUE AS hot_key_found
FROM o JOIN customer USING (c_custkey) GROUP BY c_nationkey
""")
def join_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders have one customer; without adaptive execution the join salts
    that key alone."""
    out = scratch_path(spark, "hot")
    orders = fixture(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(F.col("o_custkey")).alias("c_custkey"), "o_orderkey", "o_totalprice")
    customers = fixture(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    with conf_scope(spark, {**ADAPTIVE_OFF, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        hot = skew.hot_keys(orders, "c_custkey", share=0.05)
        joined = skew.join_salted(orders, customers, "c_custkey", hot)
        agg.grouped_sums(joined, {"c_nationkey": F.col("c_nationkey")}, {"revenue": F.col("o_totalprice")},
                         count_as="row_cnt").write.parquet(out)
    return spark.read.parquet(out).select(
        "c_nationkey", "row_cnt", F.round("revenue", 2).alias("revenue"), F.lit(hot == [1]).alias("hot_key_found"))


@register("""
SELECT l_returnflag AS region, l_linestatus AS product_category, count(*) AS cnt,
       round(sum(l_extendedprice), 2) AS total_amount
FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-06-01' AND TIMESTAMP '1999-12-31' AND l_returnflag IN ('A', 'N')
GROUP BY ALL
""")
def agg_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over a cached table; only the report outlives the cache."""
    out = scratch_path(spark, "report")
    needed = fixture(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice"
    )
    start, end = (F.lit(day).cast("timestamp_ntz") for day in (date(1996, 6, 1), date(1999, 12, 31)))
    with cached(needed) as held:
        sums = agg.grouped_sums(
            held, {"region": F.col("l_returnflag"), "product_category": F.col("l_linestatus")},
            {"total_amount": F.col("l_extendedprice")},
            condition=F.col("l_shipdate").between(start, end) & F.col("l_returnflag").isin("A", "N"),
            count_as="cnt",
        )
        sums.withColumn("total_amount", F.round("total_amount", 2)).write.parquet(out)
    return spark.read.parquet(out).orderBy(F.desc("total_amount"))


@register("""
SELECT o_custkey, count(*) AS trip_count FROM orders GROUP BY o_custkey
ORDER BY trip_count DESC, o_custkey LIMIT 20
""")
def view_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = agg.top_counts(fixture(spark, sf_dir, "orders"), "o_custkey", 20, "trip_count")
    return agg.create_view(report, "vw_top_customers")


@register("""
SELECT o_orderpriority, round(avg(o_totalprice), 2) AS avg_o_totalprice,
       round(sum(o_totalprice), 2) AS total_o_totalprice
FROM orders GROUP BY o_orderpriority
""")
def view_avg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = agg.grouped_mean_and_sum(fixture(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return agg.create_view(report, "vw_price_analysis")


@register("SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def topk_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.latest_rows(fixture(spark, sf_dir, "orders"), 5, "o_orderdate", "o_orderkey")
