"""Time the headline queries; prints one JSON line.

Two groups: registered queries over the tables in $BENCH_SF_DIR, and the
published demo queries (names start with ``demo_``) over computed tables of the
published sizes, 10 and 20 million rows. Every run is a full execution into the
no-op sink, after one to warm up. Times are the median of three runs, for jobs that
write tables one run; setting up the demo tables is timed apart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.operators import layout
from lakeloom.operators.aggregates import filtered_sum, grouped_sums, star_join_sums
from lakeloom.queries import REGISTRY
from lakeloom.session import ADAPTIVE_OFF, ADAPTIVE_ON, build_session, conf_scope, scratch_path
from lakeloom.sources import ranges

# Labels, day counts and key counts of the published demo tables.
REGIONS = ("NA", "EMEA", "APAC", "LATAM", "ANZ", "INDIA")
CATEGORIES = ("Electronics", "Apparel", "Grocery", "Home", "Sports", "Toys")
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
CUSTOMERS, PRODUCTS, DAYS, WIDE_REGIONS, WIDE_CHANNELS = 500_000, 5_000, 730, 12, 30
SALES = {
    "customer_id": ranges.cycle(200_000), "event_date": ranges.days("2023-01-01", 365),
    "amount": ranges.drawn(50_000, "double", per=100.0), "units": ranges.drawn(5, "int", first=1, salt=1),
    "channel": ranges.cases(("web", "store", "partner", "mobile")),
}
TRANSACTIONS = {
    "txn_id": lambda key: key, "txn_date": ranges.days("2023-01-01", DAYS), "customer_id": ranges.cycle(100_000),
    "product_id": ranges.cycle(PRODUCTS), "amount": ranges.drawn(50_000, "decimal(10,2)", per=100.0),
}

READS = (
    "join_star_agg", "agg_wide", "agg_point_range", "agg_filtered_sum", "agg_approx_distinct", "view_topk",
    "view_avg_sum", "dedup_latest", "event_decode", "fn_event_id", "expect_metrics", "dq_report", "dq_duplicate_keys",
    "dq_ref_parent_child", "gov_mask_nonmember", "gov_rls_nonmember",
)
JOBS = (
    "src_file_stream", "stream_dedup_evt", "stream_dedup_key", "files_to_view", "upsert_all", "unify_stream_merge",
    "incremental_load", "agg_cached", "layout_compact", "layout_zorder", "layout_partition",
)


def draw(count: int, salt: int) -> Column:
    """A repeatable whole number below ``count`` from the row's id."""
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count))


def label(names: tuple[str, ...], salt: int) -> Column:
    return F.get(F.array(*map(F.lit, names)), draw(len(names), salt).cast("int"))


def day(start: str, salt: int, count: int = DAYS) -> Column:
    return F.date_add(F.lit(start).cast("date"), draw(count, salt).cast("int"))


def money(salt: int) -> Column:
    return draw(50_000, salt) / 100


def regional_table(ids: DataFrame) -> DataFrame:
    rows = ids.select("id", label(REGIONS[:4], 2).alias("region"), label(CATEGORIES[:4], 3).alias("product_category"),
                      day("2024-01-01", 4, 365).alias("order_date"), money(5).alias("revenue"))
    return rows.withColumn("order_month", F.month("order_date"))


def fact_table(ids: DataFrame, customers: int) -> DataFrame:
    return ids.select("id", draw(customers, 6).alias("customer_id"), label(REGIONS[:4], 7).alias("region"),
                      label(CATEGORIES, 8).alias("product_category"), day("2025-01-01", 9, 365).alias("event_date"),
                      money(10).alias("amount"))


def dimension_table(ids: DataFrame) -> DataFrame:
    wide = [F.sha2(F.concat_ws("-", "id", F.lit(k)), 256).alias(f"note_{k}") for k in range(3)]
    return ids.select(F.col("id").alias("customer_id"), label(TIERS, 11).alias("customer_tier"), *wide)


def cached_table(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("id").alias("sale_id"), label(REGIONS, 12).alias("region"),
                      label(CATEGORIES, 13).alias("product_category"), money(14).alias("amount"),
                      day("2022-01-01", 15).alias("txn_date"))


def wide_table(ids: DataFrame) -> DataFrame:
    return ids.select(
        F.col("id").alias("sale_id"), draw(CUSTOMERS, 16).alias("customer_id"), draw(PRODUCTS, 17).alias("product_id"),
        day("2023-01-01", 18).alias("sale_date"), (draw(10, 19) + 1).alias("quantity"), money(20).alias("unit_price"),
        draw(WIDE_REGIONS, 21).alias("region_id"), draw(WIDE_CHANNELS, 22).alias("channel_id"))


def median_seconds(make: Callable[[], DataFrame], runs: int = 3, warm: bool = True) -> float:
    if warm:
        layout.timed(make, runs=1)
    return round(statistics.median(layout.timed(make, runs)), 3)


def sweep(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds = {}
    for name in READS:
        seconds[name] = median_seconds(lambda: REGISTRY[name].run(spark, sf_dir))
    for name in JOBS:  # once to warm up, as for reads; a job writes below a folder of its own each time
        seconds[name] = median_seconds(lambda: REGISTRY[name].run(spark, sf_dir), runs=1)
    return seconds


# Fixed values, down to ``clustered_sum``: filters of the published queries.


def point_range(spark: SparkSession, path: str) -> DataFrame:
    june = F.col("event_date").between(F.lit("2023-06-01").cast("date"), F.lit("2023-06-30").cast("date"))
    return grouped_sums(
        spark.read.parquet(path), {"event_date": F.col("event_date")},
        {"revenue": F.col("amount"), "units": F.col("units")}, condition=(F.col("customer_id") == 12345) & june,
    ).orderBy("event_date")


def week_sum(rows: DataFrame) -> DataFrame:
    week = (F.col("txn_date") >= F.lit("2024-06-01").cast("date")) & (F.col("txn_date") < F.lit("2024-06-08").cast("date"))
    return filtered_sum(rows, week, F.col("amount"), "revenue")


def wide_aggregate(spark: SparkSession, path: str) -> DataFrame:
    window = (F.col("sale_date") >= F.lit("2024-01-01").cast("date")) & (
        F.col("sale_date") < F.lit("2024-10-01").cast("date")
    )
    rows = spark.read.parquet(path).where(window & F.col("region_id").isin(1, 2, 3, 4, 5, 6, 7, 8))
    return rows.groupBy("region_id", "channel_id", F.date_trunc("month", "sale_date").alias("sale_month")).agg(
        F.count("*").alias("orders"), F.sum("quantity").alias("units"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"),
        F.approx_count_distinct("customer_id").alias("approx_customers"),
    ).orderBy(F.desc("revenue"))


def star(spark: SparkSession, fact: str, dimension: str) -> DataFrame:
    return star_join_sums(
        spark.read.parquet(fact), spark.read.parquet(dimension), "customer_id",
        {"region": F.col("region"), "product_category": F.col("product_category"),
         "customer_tier": F.col("customer_tier"), "event_month": F.date_trunc("month", "event_date")},
        {"revenue": F.col("amount")},
    )


def cached_report(rows: DataFrame) -> DataFrame:
    kept = F.col("txn_date").between(F.lit("2022-06-01").cast("date"), F.lit("2022-12-31").cast("date"))
    return grouped_sums(
        rows, {"region": F.col("region"), "product_category": F.col("product_category")},
        {"total_amount": F.col("amount")}, condition=kept & F.col("region").isin("NA", "EMEA", "APAC"), count_as="cnt",
    ).orderBy(F.desc("total_amount"))


def clustered_sum(spark: SparkSession, path: str) -> DataFrame:
    kept = (F.col("region") == "APAC") & (F.col("product_category") == "Electronics")
    return filtered_sum(spark.read.parquet(path), kept, F.col("revenue"), "revenue")


def demo(spark: SparkSession, rows: int) -> tuple[dict[str, float], dict[str, float]]:
    seconds: dict[str, float] = {}
    setup: dict[str, float] = {}

    def prepare(name: str, write: Callable[[str], None]) -> str:
        path = scratch_path(spark, name)
        started = time.perf_counter()
        write(path)
        setup[name] = round(time.perf_counter() - started, 3)
        return path

    def ids(count: int) -> DataFrame:
        return spark.range(count)

    files = max(2, rows // 5_000)
    small = prepare("small_files", lambda path: layout.spread_by(
        ranges.computed(ids(rows), SALES), files, "customer_id", "event_date").write.parquet(path))
    seconds["demo_point_range_small_files"] = median_seconds(lambda: point_range(spark, small))
    compacted = prepare("compacted", lambda path: layout.compact(spark, small, path))
    seconds["demo_point_range_compacted"] = median_seconds(lambda: point_range(spark, compacted))
    ordered = prepare("zordered", lambda path: layout.cluster(
        spark.read.parquet(small), path, ["customer_id", "event_date"], 8))
    seconds["demo_point_range_zordered"] = median_seconds(lambda: point_range(spark, ordered))

    flat = prepare("transactions", lambda path: ranges.computed(ids(2 * rows), TRANSACTIONS).write.parquet(path))
    seconds["demo_week_sum_flat"] = median_seconds(lambda: week_sum(spark.read.parquet(flat)))
    prepare("transactions_daily", lambda path: layout.write_partitioned_table(
        spark.read.parquet(flat), "transactions_daily", path, ["txn_date"]))
    seconds["demo_week_sum_partitioned"] = median_seconds(lambda: week_sum(spark.table("transactions_daily")))

    wide = prepare("wide_sales", lambda path: wide_table(ids(rows)).write.parquet(path))
    seconds["demo_wide_aggregate"] = median_seconds(lambda: wide_aggregate(spark, wide))

    regional = prepare("regional", lambda path: regional_table(ids(rows)).write.parquet(path))
    clustered = prepare("regional_clustered", lambda path: layout.cluster(
        spark.read.parquet(regional), path, ["region", "product_category", "order_month"], 16, bits=4))
    seconds["demo_regional_sum_clustered"] = median_seconds(lambda: clustered_sum(spark, clustered))

    fact = prepare("star_fact", lambda path: fact_table(ids(rows), rows // 5).write.parquet(path))
    dimension = prepare("star_dimension", lambda path: dimension_table(ids(rows // 5)).write.parquet(path))
    bad_shuffle = {"spark.sql.shuffle.partitions": "2000"}
    with conf_scope(spark, {**bad_shuffle, **ADAPTIVE_OFF}):
        seconds["demo_star_adaptive_off"] = median_seconds(lambda: star(spark, fact, dimension), runs=1, warm=False)
    with conf_scope(spark, {**bad_shuffle, **ADAPTIVE_ON}):
        seconds["demo_star_adaptive_on"] = median_seconds(lambda: star(spark, fact, dimension))

    sales = prepare("cached_sales", lambda path: cached_table(ids(rows)).write.parquet(path))
    seconds["demo_report_uncached"] = median_seconds(lambda: cached_report(spark.read.parquet(sales)))
    with layout.cached(spark.read.parquet(sales)) as held:
        seconds["demo_report_cached"] = median_seconds(lambda: cached_report(held))
    return seconds, setup


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_DEMO_ROWS", "10000000"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = sweep(spark, sf_dir)
    setup: dict[str, float] = {}
    if rows:
        demo_seconds, setup = demo(spark, rows)
        seconds |= demo_seconds
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "setup": setup, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus), "demo_rows": rows,
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
