"""Queries over column masks and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.operators import governance as gov
from lakeloom.operators.sinks import drop_table, register_table
from lakeloom.queries.registry import register
from lakeloom.session import scratch_path
from lakeloom.sources.files import fixture

GROUP = "order_auditors"
MASK = gov.MaskPolicy("o_orderkey", GROUP)


def _only_open() -> gov.RowPolicy:
    return gov.RowPolicy(GROUP, F.col("o_orderstatus") == "O")


MASKED_SQL = "SELECT * REPLACE ('*****' AS o_orderkey) FROM orders"
OPEN_SQL = "SELECT * FROM orders WHERE o_orderstatus = 'O'"


@register("SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS o_orderkey) FROM orders")
def gov_mask_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.mask(fixture(spark, sf_dir, "orders"), [MASK], {GROUP})


@register(MASKED_SQL)
def gov_mask_nonmember(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.mask(fixture(spark, sf_dir, "orders"), [MASK], {"Analysts"})


def _memberships(spark: SparkSession, sf_dir: str) -> str:
    """A membership table in which the current user has no group of interest:
    each customer belongs to the group of its segment."""
    name = "policy_memberships"
    fixture(spark, sf_dir, "customer").select(
        F.col("c_name").alias("user_name"), F.col("c_mktsegment").alias("group_name")
    ).createOrReplaceTempView(name)
    return name


@register(MASKED_SQL)
def gov_mask_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view whose masked column goes through a SQL function; membership is
    looked up at every read."""
    fixture(spark, sf_dir, "orders").createOrReplaceTempView("policy_orders")
    gov.create_mask_function(spark, "mask_order_key", "o_orderkey", "BIGINT")
    member = gov.member_test(GROUP, _memberships(spark, sf_dir))
    gov.create_masked_view(spark, "policy_masked_orders", "policy_orders", {"o_orderkey": "mask_order_key"}, member)
    return spark.table("policy_masked_orders")


def _as_member(spark: SparkSession, sf_dir: str) -> str:
    """The same memberships, and the current user in the group of interest."""
    name = "policy_members"
    mine = spark.sql("SELECT current_user() AS user_name").withColumn("group_name", F.lit(GROUP))
    spark.table(_memberships(spark, sf_dir)).unionByName(mine).createOrReplaceTempView(name)
    return name


@register("SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS o_orderkey) FROM orders")
def gov_mask_view_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture(spark, sf_dir, "orders").createOrReplaceTempView("policy_orders")
    gov.create_mask_function(spark, "mask_order_key", "o_orderkey", "BIGINT")
    member = gov.member_test(GROUP, _as_member(spark, sf_dir))
    gov.create_masked_view(spark, "policy_member_orders", "policy_orders", {"o_orderkey": "mask_order_key"}, member)
    return spark.table("policy_member_orders")


@register(MASKED_SQL)
def gov_mask_view_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored view and function over stored tables; the rows outlive both."""
    orders, members, out = (scratch_path(spark, part) for part in ("orders", "members", "rows"))
    mark = orders.rsplit("-", 1)[1]
    tables = {f"orders_{mark}": (fixture(spark, sf_dir, "orders"), orders),
              f"members_{mark}": (spark.table(_memberships(spark, sf_dir)), members)}
    for name, (rows, path) in tables.items():
        register_table(rows, name, path)
    try:
        gov.create_mask_function(spark, f"mask_{mark}", "o_orderkey", "BIGINT", temporary=False)
        gov.create_masked_view(spark, f"masked_{mark}", f"orders_{mark}", {"o_orderkey": f"mask_{mark}"},
                               gov.member_test(GROUP, f"members_{mark}"), temporary=False)
        spark.table(f"masked_{mark}").write.parquet(out)
    finally:
        spark.sql(f"DROP VIEW IF EXISTS masked_{mark}")
        spark.sql(f"DROP FUNCTION IF EXISTS mask_{mark}")
        for name in tables:
            drop_table(spark, name)
    return spark.read.parquet(out)


@register("SELECT * FROM orders")
def gov_rls_view_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture(spark, sf_dir, "orders").createOrReplaceTempView("policy_orders")
    member = gov.member_test(GROUP, _as_member(spark, sf_dir))
    gov.create_filtered_view(spark, "policy_member_rows", "policy_orders", member, "o_orderstatus = 'O'")
    return spark.table("policy_member_rows")


@register("SELECT * FROM orders")
def gov_rls_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.row_filter(fixture(spark, sf_dir, "orders"), _only_open(), {GROUP})


@register(OPEN_SQL)
def gov_rls_nonmember(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.row_filter(fixture(spark, sf_dir, "orders"), _only_open(), {"Analysts"})


@register(OPEN_SQL)
def gov_rls_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture(spark, sf_dir, "orders").createOrReplaceTempView("policy_orders")
    member = gov.member_test(GROUP, _memberships(spark, sf_dir))
    gov.create_filtered_view(spark, "policy_open_orders", "policy_orders", member, "o_orderstatus = 'O'")
    return spark.table("policy_open_orders")


@register("SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def gov_rls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own predicate on top of the policy."""
    visible = gov.row_filter(fixture(spark, sf_dir, "orders"), _only_open(), set())
    return visible.where(F.col("o_orderpriority") == "1-URGENT")
