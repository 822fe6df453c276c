import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeloom.operators import layout, sinks
from lakeloom.queries import layouts
from lakeloom.session import conf_scope
from lakeloom.sources.files import stored_bytes, stored_files, table_detail
from tests.conftest import plan_of, rows_of


def _files(path):
    return [name for name in os.listdir(path) if name.endswith(".parquet")]


def _grid(spark, n=4096):
    return spark.range(n).select((F.col("id") % 64).alias("a"), F.expr("int(id / 64)").alias("b"), F.col("id"))


def test_compact_merges_files_and_keeps_rows(spark, folder):
    small, large = folder("small"), folder("large")
    layout.spread_by(_grid(spark), 32, "id").write.parquet(small)
    layout.compact(spark, small, large)
    assert len(_files(small)) == 32 and len(_files(large)) == 1
    assert rows_of(spark.read.parquet(large)) == rows_of(_grid(spark))


def test_compact_respects_the_file_size(spark, folder):
    small, large = folder("small"), folder("large")
    layout.spread_by(_grid(spark, 65_536), 32, "id").write.parquet(small)
    layout.compact(spark, small, large, file_bytes=stored_bytes(spark, small) // 4)
    assert 3 <= len(_files(large)) <= 8



def test_z_order_touches_few_files_in_each_dimension(spark, folder):
    path = folder("z")
    layout.cluster(_grid(spark), path, ["a", "b"], 16)
    bounds = layout.file_bounds(spark.read.parquet(path), ["a", "b"])
    assert bounds.count() == 16 and bounds.agg(F.sum("row_count")).first()[0] == 4096
    for column in ("a", "b"):
        touched = bounds.where(f"min_{column} <= 20 AND max_{column} >= 20").count()
        assert touched <= 10, (column, touched)
    both = bounds.where("min_a <= 20 AND max_a >= 20 AND min_b <= 20 AND max_b >= 20").count()
    assert both <= 4


def test_hot_key_is_cut_into_several_files(spark, folder):
    path = folder("hot")
    rows = spark.range(8_000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    layout.cluster(rows.withColumn("c", F.lit(1)), path, ["a", "c"], 8)
    bounds = layout.file_bounds(spark.read.parquet(path), ["a"])
    assert bounds.agg(F.max("row_count")).first()[0] < 2_500
    assert spark.read.parquet(path).count() == 8_000


def test_z_value_handles_text_dates_nulls(spark):
    df = spark.sql("""SELECT * FROM VALUES ('APAC', DATE '2024-01-01', 1.5D), (NULL, NULL, NULL),
                      ('NA', DATE '2024-05-01', 2.5D), ('EMEA', DATE '2024-03-01', 0.5D) AS t(r, d, x)""")
    coded = layout.with_z_value(df, ["r", "d", "x"], bits=3)
    assert coded.columns == ["r", "d", "x", layout.Z_VALUE] and coded.where(f"{layout.Z_VALUE} IS NULL").count() == 0
    with pytest.raises(TypeError):
        layout.with_z_value(spark.sql("SELECT array(1) AS a"), ["a"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60))
def test_single_column_code_is_monotonic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    coded = sorted((row["v"], row[layout.Z_VALUE]) for row in layout.with_z_value(df, ["v"], bits=4).collect())
    codes = [code for _, code in coded]
    assert codes == sorted(codes)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abcé", max_size=9), min_size=1, max_size=30))
def test_text_code_follows_byte_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    coded = sorted((row["v"].encode(), row[layout.Z_VALUE]) for row in layout.with_z_value(df, ["v"], bits=4).collect())
    assert [code for _, code in coded] == sorted(code for _, code in coded)


def test_partitioned_read_prunes_folders(spark, folder):
    path = folder("parts")
    layout.write_partitioned_table(_grid(spark), "grid_parts", path, ["b"])
    read = spark.table("grid_parts").where("b = 3").agg(F.sum("id"))
    assert "PartitionFilters: [isnotnull(b" in plan_of(read) and read.first()[0] == sum(range(192, 256))
    assert {name for name in os.listdir(path) if name.startswith("b=")} == {f"b={i}" for i in range(64)}
    spark.sql("DROP TABLE grid_parts")


def test_oversized_partition_is_split(spark, folder):
    """The folder with most rows is written by several tasks, a small one by one."""
    path = folder("skewed")
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 4 + 1).alias("p"), F.xxhash64("id").alias("v"))
    with conf_scope(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
                            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}):
        layout.write_partitioned(rows.repartition(8), path, ["p"])
    files = {name: len(_files(f"{path}/{name}")) for name in os.listdir(path) if name.startswith("p=")}
    assert files["p=0"] >= 3 and min(files.values()) == 1
    assert spark.read.parquet(path).count() == 200_000


def test_filter_and_columns_reach_the_scan(spark, folder):
    path = folder("flat")
    _grid(spark).write.parquet(path)
    plan = plan_of(spark.read.parquet(path).where("a = 3").agg(F.sum("b")))
    assert "EqualTo(a,3)" in plan and "ReadSchema: struct<a:bigint,b:int>" in plan


def test_cluster_adds_only_newer_files(spark, folder):
    source, target = folder("source"), folder("target")
    _grid(spark).write.parquet(source)
    layout.cluster_files(spark, source, target, ["a", "b"])
    before = set(_files(target))
    for name in _files(source):
        os.utime(os.path.join(source, name), (1_600_000_000, 1_600_000_000))
    spark.range(10).selectExpr("id a", "int(id) b", "id").write.mode("append").parquet(source)
    layout.cluster_files(spark, source, target, ["a", "b"], modified_after="2021-01-01T00:00:00")
    assert len(set(_files(target)) - before) == 1 and before < set(_files(target))
    assert spark.read.parquet(target).count() == 4096 + 10


def test_long_text_and_large_integers_are_told_apart(spark):
    for values, kind in (([f"Customer#{k:09d}" for k in range(64)], "string"), ([(1 << 60) + k for k in range(64)], "bigint")):
        coded = layout.with_z_value(spark.createDataFrame([(v,) for v in values], f"v {kind}"), ["v"], bits=4)
        assert coded.select(layout.Z_VALUE).distinct().count() == 16


def test_partitions_survive_compaction_and_swap(spark, folder):
    old, new = folder("old"), folder("new's")
    rows = spark.range(400).selectExpr("id", "concat('g ', id % 4, char(39)) AS g", "if(id % 4 = 0, NULL, id % 2) AS h")
    layout.write_partitioned_table(rows.repartition(8), "grid_moved", old, ["g", "h"])
    layout.compact(spark, old, new, partition_by=["g", "h"])
    assert rows_of(spark.read.parquet(new).select("id", "g", "h")) == rows_of(rows)
    spark.range(100).selectExpr("1000 + id AS id", "'g 9' AS g", "7 AS h").write.mode("append").partitionBy("g", "h").parquet(new)
    layout.swap_location(spark, "grid_moved", new)
    assert spark.table("grid_moved").count() == 500 and spark.table("grid_moved").where("g = 'g 9'").count() == 100
    assert spark.table("grid_moved").where("h IS NULL").count() == 100
    spark.sql("DROP TABLE grid_moved")


def test_swap_cut_short_leaves_no_partition_empty(spark, folder, monkeypatch):
    old, new = folder("old"), folder("new")
    rows = spark.range(400).selectExpr("id", "id % 5 AS g")
    layout.write_partitioned_table(rows.repartition(4), "grid_cut", old, ["g"])
    layout.write_partitioned(rows.where("g < 4").selectExpr("id + 1000 AS id", "g"), new, ["g"])
    partition, done = layout._partition, []

    def failing(spec):
        if len(done) == 2:
            raise RuntimeError("driver lost")
        done.append(spec)
        return partition(spec)

    monkeypatch.setattr(layout, "_partition", failing)
    with pytest.raises(RuntimeError):
        layout.swap_location(spark, "grid_cut", new)
    spark.catalog.refreshTable("grid_cut")
    assert rows_of(spark.table("grid_cut").groupBy("g").count()) == [(g, 80) for g in range(5)]
    assert spark.table("grid_cut").where("id >= 1000").select("g").distinct().count() == 2
    monkeypatch.undo()
    layout.swap_location(spark, "grid_cut", new)
    assert rows_of(spark.table("grid_cut").groupBy("g").count()) == [(g, 80) for g in range(4)]
    assert spark.table("grid_cut").where("id < 1000").count() == 0
    layout.swap_location(spark, "grid_cut", new)
    assert spark.table("grid_cut").count() == 320
    spark.sql("DROP TABLE grid_cut")


def test_spread_is_the_same_when_repeated(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), "id")
    parts = [{tuple(row) for row in layout.spread_by(rows.repartition(n), 4, "k", salts=4).select(
        "id", F.spark_partition_id()).collect()} for n in (2, 5)]
    assert parts[0] == parts[1]


def test_clear_cache(spark):
    held = _grid(spark).persist()
    layout.clear_cache(spark)
    assert "InMemoryRelation" not in plan_of(held.select("a"))


def test_swap_and_statistics(spark, folder):
    old, new = folder("old"), folder("new")
    sinks.register_table(_grid(spark), "grid_swap", old)
    layout.compact(spark, old, new)
    layout.swap_location(spark, "grid_swap", new)
    assert spark.table("grid_swap").count() == 4096
    assert all(new in name for name in spark.table("grid_swap").inputFiles())
    layout.collect_statistics(spark, "grid_swap", "all")
    stats = spark.sql("DESCRIBE EXTENDED grid_swap").where("col_name = 'Statistics'").first()["data_type"]
    assert "4096 rows" in stats
    sinks.drop_table(spark, "grid_swap")
    assert not sinks.table_exists(spark, "grid_swap")


def test_detail_lists_files(spark, folder):
    path = folder("detail")
    _grid(spark).repartition(3).write.parquet(path)
    sizes = sum(os.path.getsize(os.path.join(path, name)) for name in _files(path))
    assert tuple(table_detail(spark, path).first()) == (3, sizes) and stored_files(spark, path).count() == 3


def test_cached_block_reads_memory_and_frees_it(spark, folder):
    path = folder("cached")
    _grid(spark).write.parquet(path)
    with layout.cached(spark.read.parquet(path)) as held:
        assert "InMemoryTableScan" in plan_of(held.groupBy("a").count())
    assert not spark.read.parquet(path).is_cached
    assert "InMemoryTableScan" not in plan_of(spark.read.parquet(path).groupBy("a").count())


def test_cached_table_serves_sql_and_is_freed(spark, folder):
    sinks.register_table(_grid(spark), "grid_cached", folder("t"))
    with layout.cached_table(spark, "grid_cached"):
        assert spark.catalog.isCached("grid_cached")
        assert "Scan In-memory table" in plan_of(spark.sql("SELECT a, count(*) FROM grid_cached GROUP BY a"))
    assert not spark.catalog.isCached("grid_cached")
    sinks.drop_table(spark, "grid_cached")


def test_timed_runs(spark):
    assert len(layout.timed(lambda: spark.range(10), runs=2)) == 2


def test_one_file_each_value(spark, folder):
    """Whole rows in one file a value, a null among them; a packing task reads no rows
    of another value, however many tasks had them."""
    source, path, staged = folder("source"), folder("each"), folder("staged")
    rows = spark.range(900).select(F.expr("nullif(id % 4, 3)").cast("int").alias("k"), F.col("id"))
    rows.repartition(6).write.parquet(source)
    layout.one_file_each(spark.read.parquet(source), path, "k", staged)
    stored = spark.read.parquet(path)
    assert stored.schema == spark.read.parquet(source).schema and rows_of(stored) == rows_of(rows)
    assert len(_files(path)) == 4
    each = stored.groupBy(F.col("_metadata.file_name")).agg(F.collect_set(F.coalesce("k", F.lit(-1))).alias("k")).collect()
    assert sorted(row["k"] for row in each) == [[-1], [0], [1], [2]]
    parts = [spark.read.parquet(os.path.join(staged, name)) for name in os.listdir(staged) if "=" in name]
    assert len(parts) == 4 and sum(part.count() for part in parts) == 900
    assert all(part.select("k").distinct().count() == 1 for part in parts)


def _lines(spark, n=6000):
    return spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.expr("int(id % 7)").alias("l_linenumber"), F.xxhash64("id").alias("l_partkey"),
        F.expr("timestamp_ntz '1996-01-01 00:00:00' + make_dt_interval(int(id % 1400))").alias("l_shipdate"))


def test_large_files_grow_in_number(spark, folder, monkeypatch):
    """A larger table has more large files, each one task's work, all left alone."""
    base = folder("tables")
    _lines(spark).write.parquet(f"{base}/lineitem.parquet")
    monkeypatch.setattr(layouts, "LARGE_FILE_BYTES", stored_bytes(spark, f"{base}/lineitem.parquet") // 3)
    stored = layouts.layout_compact_small(spark, base).withColumn("file", F.col("_metadata.file_name"))
    flags = stored.groupBy("file_was").agg(F.countDistinct("file").alias("files"), F.every("fewer_files").alias("fewer")).collect()
    assert {row["file_was"]: row["files"] >= 3 for row in flags} == {"left alone": True, "rewritten": True}
    assert all(row["fewer"] for row in flags)
    assert rows_of(stored.select(*_lines(spark).columns)) == rows_of(_lines(spark))
    early = stored.where("l_shipdate < '1998-01-01'").select("file_was").distinct().collect()
    assert [row[0] for row in early] == ["left alone"]


def test_partitioned_write_keeps_folders_open(spark, folder, monkeypatch):
    """No task sorts its rows by folder as long as the folders are few."""
    seen, scope = [], layout.conf_scope

    def noted(session, settings):
        seen.append(dict(settings))
        return scope(session, settings)

    monkeypatch.setattr(layout, "conf_scope", noted)
    path = folder("parts")
    layout.write_partitioned(_lines(spark), path, ["l_linenumber"])
    assert seen == [{"spark.sql.maxConcurrentOutputFileWriters": "16"}]
    assert rows_of(spark.read.parquet(path).select(*_lines(spark).columns)) == rows_of(_lines(spark))
    many = folder("many")  # more folders than are kept open
    layout.write_partitioned(_grid(spark), many, ["b"])
    assert rows_of(spark.read.parquet(many).select("a", "b", "id")) == rows_of(_grid(spark))


def test_files_to_cluster_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(layouts, "stored_bytes", lambda *_: 6 << 30)
    assert layouts._files(spark, "/none") == 96
