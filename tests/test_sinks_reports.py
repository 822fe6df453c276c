
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import aggregates as agg, sinks
from lakeloom.session import ADAPTIVE_OFF, ADAPTIVE_ON, conf_scope, scratch_path
from lakeloom.sources import ranges
from lakeloom.sources.files import read_files
from tests.conftest import plan_of, rows_of


def test_formats_round_trip(spark, folder):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS t")
    for file_format in ("parquet", "json", "csv"):
        path = folder(file_format)
        sinks.write_files(df, path, file_format)
        row = read_files(spark, path, file_format).select("a", "b", F.col("t").cast("timestamp_ntz").cast("string")).first()
        assert (str(row[0]), row[1], row[2]) == ("1", "x", "2024-01-01 00:00:00.123456")
    with pytest.raises(ValueError):
        read_files(spark, "x", "xml")
    with pytest.raises(ValueError):
        sinks.write_files(df, "x", "xml")


def test_append_run_counts_and_replaces(spark, folder):
    path = folder("bronze")
    rows = spark.range(5).withColumn("_run_id", F.lit("r1"))
    assert sinks.append_run(rows, path, "r1") == 5 and sinks.append_run(rows, path, "r1") == 5
    assert sinks.append_run(rows.withColumn("_run_id", F.lit("r2")).limit(2), path, "r2") == 2
    assert spark.read.parquet(path).count() == 7
    assert rows_of(sinks.read_run(spark, path, "r2").select("_run_id").distinct()) == [("r2",)]


def test_table_comment_properties_and_names(spark, folder):
    sinks.ensure_schema(spark, "silver_db")
    sinks.create_table(spark, "silver_db.t", "a INT", folder("t"), comment="it's deduped", properties={"quality": "silver"})
    assert sinks.table_comment(spark, "silver_db.t") == "it's deduped"
    assert sinks.table_properties(spark, "silver_db.t")["quality"] == "silver"
    assert sinks.two_level_name("silver_db.t") == ("silver_db", "t")
    with pytest.raises(ValueError):
        sinks.two_level_name("t")
    assert sinks.current_context(spark)[0] == "spark_catalog"
    sinks.drop_table(spark, "silver_db.t")


def test_insert_overwrite_matches_by_name(spark, folder):
    sinks.create_table(spark, "by_name", "a INT, b STRING", folder("t"))
    sinks.insert_overwrite(spark.createDataFrame([("x", 1)], "b string, a int"), "by_name")
    sinks.insert_overwrite(spark.createDataFrame([("y", 2)], "b string, a int"), "by_name")
    assert rows_of(spark.table("by_name")) == [(2, "y")]
    sinks.drop_table(spark, "by_name")


def _star(spark, dimension_rows=3000):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % dimension_rows).alias("customer_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("event_date"),
        (F.col("id") % 997 / 4).alias("amount"))
    dimension = spark.range(dimension_rows).select(
        F.col("id").alias("customer_id"), (F.col("id") % 4).cast("string").alias("customer_tier"))
    return agg.star_join_sums(
        hot, dimension, "customer_id",
        {"tier": F.col("customer_tier"), "month": F.date_trunc("month", "event_date")}, {"revenue": F.col("amount")},
    ).withColumn("revenue", F.round("revenue", 2))


def test_adaptive_profiles_agree(spark):
    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with conf_scope(spark, {**ADAPTIVE_ON, **no_broadcast}):
        with_adaptive = _star(spark)
        on, plan_on = rows_of(with_adaptive), plan_of(with_adaptive)
    with conf_scope(spark, {**ADAPTIVE_OFF, **no_broadcast}):
        without = _star(spark)
        off, plan_off = rows_of(without), plan_of(without)
    assert on == off
    assert "AdaptiveSparkPlan" in plan_on and "AdaptiveSparkPlan" not in plan_off
    assert "SortMergeJoin" in plan_on and "partial_sum" in plan_on


def test_hot_join_key_is_split(spark):
    """With sizes scaled down, adaptive execution splits the hot partition."""
    small = {
        **ADAPTIVE_ON, "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    with conf_scope(spark, small):
        joined = _star(spark)
        joined.collect()
        assert "skew=true" in plan_of(joined)


def test_conf_scope_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with conf_scope(spark, {"spark.sql.shuffle.partitions": "77", "lakeloom.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and spark.conf.get("lakeloom.test", None) is None


class Settings:
    """Stands in for a session: only its settings."""

    def __init__(self, **values):
        self.conf = {name.replace("_", "."): value for name, value in values.items()}


def test_scratch_follows_the_checkpoint_setting():
    shared = Settings(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    assert scratch_path(shared, "x").startswith("hdfs://shared/x-")
    assert scratch_path(Settings(spark_master="local[2]"), "x")
    with pytest.raises(RuntimeError, match="shared folder"):
        scratch_path(Settings(spark_master="yarn"), "x")


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    top = agg.top_counts(df, "k", 2, "n")
    assert [tuple(row) for row in top.collect()] == [("c", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_distinct_estimate_is_close(spark):
    df = spark.range(100_000).select(F.lit(1).alias("g"), (F.col("id") % 50_000).alias("v"))
    assert abs(agg.distinct_estimate(df, ["g"], "v").first()["approx_v"] - 50_000) <= 0.15 * 50_000


def test_view_is_evaluated_per_read(spark, folder):
    path = folder("view")
    spark.range(2).write.parquet(path)
    view = agg.create_view(spark.read.parquet(path).groupBy().count(), "v_count")
    assert view.first()[0] == 2


def test_demo_tables_repeat(spark):
    spec = {"a": ranges.cycle(7, first=2), "b": ranges.days("2020-02-27", 5), "c": ranges.drawn(9, "int", salt=1), "d": ranges.cases("xyz")}
    made = [rows_of(ranges.computed(spark.range(0, 200, numPartitions=parts), spec)) for parts in (3, 7)]
    assert made[0] == made[1] and len(made[0]) == 200
    draws = spark.range(20_000).select(ranges.mixed(F.col("id"), 10).alias("d")).groupBy("d").count().collect()
    assert len(draws) == 10 and all(1_600 < row["count"] < 2_400 for row in draws)




def test_star_query_never_broadcasts_the_fact(spark):
    """Of each join the built side is a dimension; lineitem only streams."""
    from lakeloom.queries.reports import join_star_agg

    result = join_star_agg(spark, "/root/testdata/sf0.1")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert final.count("BroadcastHashJoin") == 2 and "BuildLeft" not in final


def test_a_retry_without_rows_leaves_none(spark, folder):
    path = folder("runs")
    rows = spark.range(5).withColumn("_run_id", F.lit("r:1"))
    assert sinks.append_run(rows, path, "r:1") == 5
    assert spark.read.parquet(path).where("_run_id = 'r:1'").count() == 5
    assert sinks.append_run(rows.limit(0), path, "r:1") == 0
    assert sinks.read_run(spark, path, "r:1").count() == 0


def test_evolving_folder_that_has_no_schema_yet(spark, folder):
    path = folder("legacy")
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(path)
    sinks.append_evolving(spark.createDataFrame([(2, 9.5)], "id int, price double"), path)
    sinks.append_evolving(spark.createDataFrame([(3, True)], "id int, good boolean"), path)
    rows = sinks.read_evolving(spark, path)
    assert rows.columns == ["id", "name", "price", "good"]
    assert rows_of(rows) == [(1, "a", None, None), (2, None, 9.5, None), (3, None, None, True)]


def test_schemas_of_two_appends_at_once_are_joined(spark, folder):
    path = folder("both")
    for schema in ("id int, a int", "id int, b string, c int"):
        sinks.store_schema(spark, path, spark.createDataFrame([], schema).schema)
    assert sinks.stored_schema(spark, path).names == ["id", "a", "b", "c"]
