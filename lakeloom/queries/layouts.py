"""Queries over layout jobs; each reads back what the job wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators import clustering, layout
from lakeloom.operators.sinks import drop_table, register_table
from lakeloom.queries.registry import register
from lakeloom.queries.reports import STAR_SQL, join_star_agg
from lakeloom.session import ADAPTIVE_OFF, conf_scope, scratch_path
from lakeloom.sources.files import fixture, fixture_glob, stored_bytes, stored_files, table_detail

#: Layout jobs move whole rows, so whole rows are compared.
LINES_SQL = "SELECT * FROM lineitem"
#: Bytes of lineitem for each large file of a folder with large and small ones.
LARGE_FILE_BYTES = 128 << 20


def _files(spark: SparkSession, sf_dir: str) -> int:
    return max(16, layout.files_for(stored_bytes(spark, fixture_glob(sf_dir, "lineitem")), layout.SORTED_FILE_BYTES))


@register(LINES_SQL)
def layout_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files into few."""
    small, large = scratch_path(spark, "small"), scratch_path(spark, "large")
    files = 4 * _files(spark, sf_dir)
    layout.spread_by(fixture(spark, sf_dir, "lineitem"), files, "l_orderkey").write.parquet(small)
    layout.compact(spark, small, large)
    return spark.read.parquet(large)


@register(LINES_SQL)
def layout_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "zorder")
    layout.cluster(fixture(spark, sf_dir, "lineitem"), path, ["l_partkey", "l_suppkey"], _files(spark, sf_dir))
    return spark.read.parquet(path)


@register("SELECT c_name, count(*) AS row_count, TRUE AS half_of_files_or_less FROM customer GROUP BY c_name")
def layout_cluster_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered by a text with a common beginning: the range of a file's names shows
    which files a name can stand in."""
    path, files = scratch_path(spark, "names"), 8
    layout.cluster(fixture(spark, sf_dir, "customer"), path, ["c_name"], files)
    stored = spark.read.parquet(path)
    bounds = layout.file_bounds(stored, ["c_name"])
    names = stored.groupBy("c_name").agg(F.count("*").alias("row_count"))
    touched = names.join(F.broadcast(bounds.select("min_c_name", "max_c_name")),  # eight rows
                         F.col("c_name").between(F.col("min_c_name"), F.col("max_c_name")))
    return touched.groupBy("c_name").agg(
        F.any_value("row_count").alias("row_count"), (F.count("*") <= files / 2).alias("half_of_files_or_less"))


@register(LINES_SQL)
def layout_cluster_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table clustered as a whole, then only its newer files."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "clustered")
    lines, columns = fixture(spark, sf_dir, "lineitem"), ["l_shipdate", "l_partkey"]
    lines.where("l_shipdate < '2000-01-01'").write.parquet(source)
    clustering.cluster_new(spark, source, target, columns)
    lines.where("l_shipdate >= '2000-01-01'").write.mode("append").parquet(source)
    clustering.cluster_new(spark, source, target, columns)
    return clustering.read_clustered(spark, target)


@register("SELECT *, TRUE AS half_of_files_or_less FROM lineitem WHERE l_partkey BETWEEN 40 AND 55 AND l_suppkey BETWEEN 3 AND 9")
def layout_file_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow lookup in a clustered table opens the files whose stored ranges match."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "clustered")
    fixture(spark, sf_dir, "lineitem").write.parquet(source)
    file_bytes = min(stored_bytes(spark, source) // 16, layout.SORTED_FILE_BYTES)
    clustering.cluster_new(spark, source, target, ["l_partkey", "l_suppkey"], file_bytes=file_bytes)
    found, opened = clustering.read_matching(spark, target, {"l_partkey": (40, 55), "l_suppkey": (3, 9)})
    files = clustering.stored_bounds(spark, target).count()
    return found.withColumn("half_of_files_or_less", F.lit(opened <= files / 2))


@register("""
SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'left alone' ELSE 'rewritten' END AS file_was,
       TRUE AS fewer_files FROM lineitem
""")
def layout_compact_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with large and small files; only the small ones are rewritten. A large
    file is one task's work, so a larger table has more of them."""
    path = scratch_path(spark, "mixed")
    lines = fixture(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < "1998-01-01"
    files = layout.files_for(stored_bytes(spark, fixture_glob(sf_dir, "lineitem")), LARGE_FILE_BYTES)
    lines.where(early).repartition(files).write.parquet(path)
    large = stored_files(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length").collect()
    lines.where(~early).repartition(24 * files).write.mode("append").parquet(path)
    done = clustering.compact_small(spark, path, file_bytes=min(row["length"] for row in large), small=0.9)
    same = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).isin([row["name"] for row in large])
    return spark.read.parquet(path).select(
        *lines.columns, F.when(same, "left alone").otherwise("rewritten").alias("file_was"),
        F.lit(done.written < done.rewritten and done.untouched == len(large)).alias("fewer_files"))


@register(LINES_SQL)
def layout_compact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned catalog table, compacted with its folders and swapped over."""
    small, large, out = (scratch_path(spark, part) for part in ("small", "large", "rows"))
    table = f"lines_{small.rsplit('-', 1)[1]}"
    lines = fixture(spark, sf_dir, "lineitem")
    layout.write_partitioned_table(lines.repartition(_files(spark, sf_dir)), table, small, ["l_linenumber"])
    try:
        layout.compact(spark, small, large, partition_by=["l_linenumber"])
        layout.swap_location(spark, table, large)
        spark.table(table).select(*lines.columns).write.parquet(out)
    finally:
        drop_table(spark, table)
    return spark.read.parquet(out).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@register(LINES_SQL)
def layout_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered by a text, a time and a number; a later arrival is clustered by
    itself and added."""
    path = scratch_path(spark, "clustered")
    lines, files = fixture(spark, sf_dir, "lineitem"), _files(spark, sf_dir)
    columns = ["l_returnflag", "l_shipdate", "l_partkey"]
    layout.cluster(lines.where("l_shipdate < '2000-01-01'"), path, columns, files, bits=5)
    layout.cluster(lines.where("l_shipdate >= '2000-01-01'"), path, columns, max(1, files // 4), bits=5, mode="append")
    return spark.read.parquet(path)


@register("""
SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ship_month, count(*) AS row_count,
       round(sum(l_extendedprice), 2) AS revenue
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-07-01' GROUP BY 1
""")
def layout_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month folders of a catalog table; the filter prunes them before listing."""
    path, out = scratch_path(spark, "monthly"), scratch_path(spark, "report")
    table = f"monthly_{path.rsplit('-', 1)[1]}"
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int")
    lines = fixture(spark, sf_dir, "lineitem").withColumn("ship_month", month)
    layout.write_partitioned_table(lines, table, path, ["ship_month"])
    try:
        some_months = spark.table(table).where(F.col("ship_month").between(199801, 199906))
        some_months.groupBy("ship_month").agg(
            F.count("*").alias("row_count"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")
        ).write.parquet(out)
    finally:
        drop_table(spark, table)
    return spark.read.parquet(out)


@register(LINES_SQL)
def layout_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files on purpose from a key with few values, by salting it."""
    path, files = scratch_path(spark, "spread"), _files(spark, sf_dir)
    layout.spread_by(fixture(spark, sf_dir, "lineitem"), files, "l_returnflag", salts=files).write.parquet(path)
    return spark.read.parquet(path)


@register("""
SELECT 'l_orderkey' AS col_name, CAST(count(*) FILTER (l_orderkey IS NULL) AS VARCHAR) AS num_nulls,
       CAST(min(l_orderkey) AS VARCHAR) AS min, CAST(max(l_orderkey) AS VARCHAR) AS max FROM lineitem
UNION ALL
SELECT 'l_linenumber', CAST(count(*) FILTER (l_linenumber IS NULL) AS VARCHAR),
       CAST(min(l_linenumber) AS VARCHAR), CAST(max(l_linenumber) AS VARCHAR) FROM lineitem
""")
def layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics as stored by the catalog."""
    path = scratch_path(spark, "lines")
    table = f"lines_{path.rsplit('-', 1)[1]}"
    columns = ["l_orderkey", "l_linenumber"]
    register_table(fixture(spark, sf_dir, "lineitem").select(*columns), table, path)
    try:
        layout.collect_statistics(spark, table, columns)
        rows = []
        for name in columns:
            facts = {row["info_name"]: row["info_value"]
                     for row in spark.sql(f"DESCRIBE EXTENDED {table} {name}").collect()}
            rows.append(tuple(facts[fact] for fact in ("col_name", "num_nulls", "min", "max")))
    finally:
        drop_table(spark, table)
    return spark.createDataFrame(rows, "col_name string, num_nulls string, min string, max string")


@register("SELECT CAST(count(DISTINCT l_linenumber) AS BIGINT) AS num_files, TRUE AS has_bytes FROM lineitem")
def layout_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File count and bytes of lineitem, stored as one file a line number."""
    path = scratch_path(spark, "lines")
    layout.one_file_each(fixture(spark, sf_dir, "lineitem"), path, "l_linenumber", scratch_path(spark, "parts"))
    detail = table_detail(spark, path)
    return detail.select(F.col("num_files").cast("bigint").alias("num_files"), (F.col("size_in_bytes") > 0).alias("has_bytes"))


@register(STAR_SQL)
def adaptive_off_star_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star query with adaptive execution off gives the same result."""
    out = scratch_path(spark, "star")
    with conf_scope(spark, ADAPTIVE_OFF):
        join_star_agg(spark, sf_dir).write.parquet(out)
    return spark.read.parquet(out)
