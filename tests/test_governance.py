import getpass

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import governance as gov
from tests.conftest import plan_of, rows_of

GROUP = "auditors"


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, "O"), (2, "P"), (3, None)], "id int, status string")


def test_mask_by_membership(orders):
    policy = [gov.MaskPolicy("id", GROUP)]
    member, other = gov.mask(orders, policy, {GROUP}), gov.mask(orders, policy, set())
    assert member.dtypes == other.dtypes == [("id", "string"), ("status", "string")]
    assert [row["id"] for row in member.collect()] == ["1", "2", "3"]
    assert {row["id"] for row in other.collect()} == {gov.MASK_TEXT} and other.count() == 3


def test_row_filter_by_membership(orders):
    policy = gov.RowPolicy(GROUP, F.col("status") == "O")
    assert rows_of(gov.row_filter(orders, policy, {GROUP})) == rows_of(orders)
    assert rows_of(gov.row_filter(orders, policy, set())) == [(1, "O")]


def test_row_filter_is_pushed_down(spark, orders, folder):
    path = folder("orders")
    orders.write.parquet(path)
    visible = gov.row_filter(spark.read.parquet(path), gov.RowPolicy(GROUP, F.col("status") == "O"), set())
    assert "EqualTo(status,O)" in plan_of(visible.where("id > 0"))


def test_groups_come_from_a_table(spark):
    members = spark.createDataFrame([("ann", "auditors"), ("ann", "staff"), ("bo", "staff")], "user_name string, group_name string")
    assert gov.groups_of(members, "ann") == {"auditors", "staff"} and gov.groups_of(members, "cy") == frozenset()


@pytest.mark.parametrize("user,expected", [("me", [("1", "O"), ("2", "P"), ("3", None)]), ("someone", [("*****", "O")])])
def test_views_look_membership_up(spark, orders, user, expected):
    me = spark.sql("SELECT current_user()").first()[0] if user == "me" else "nobody-" + getpass.getuser()
    spark.createDataFrame([(me, GROUP)], "user_name string, group_name string").createOrReplaceTempView("members")
    orders.createOrReplaceTempView("gov_orders")
    member = gov.member_test(GROUP, "members")
    gov.create_filtered_view(spark, "gov_open", "gov_orders", member, "status = 'O'")
    gov.create_mask_function(spark, "gov_hide", "id", "INT")
    gov.create_masked_view(spark, "gov_masked", "gov_open", {"id": "gov_hide"}, member)
    assert rows_of(spark.table("gov_masked")) == expected


def test_persistent_function_and_view(spark, orders, folder):
    orders.write.format("parquet").option("path", folder("t")).saveAsTable("gov_table")
    gov.create_mask_function(spark, "gov_keep", "id", "INT", temporary=False)
    gov.create_masked_view(spark, "gov_view", "gov_table", {"id": "gov_keep"}, "false", temporary=False)
    assert {row["id"] for row in spark.table("gov_view").collect()} == {gov.MASK_TEXT}
    spark.sql("DROP VIEW gov_view")
    spark.sql("DROP FUNCTION gov_keep")
    spark.sql("DROP TABLE gov_table")


@pytest.mark.parametrize("group", ["o'neil", "\\' OR 1=1 OR '", "back\\slash", "\\"])
def test_names_with_quotes_and_backslashes_are_not_code(spark, group):
    user = spark.sql("SELECT current_user() AS u").first()["u"]
    spark.createDataFrame([(user, "other")], "user_name string, group_name string").createOrReplaceTempView("`odd members`")
    test = gov.member_test(group, "odd members")
    assert spark.sql(f"SELECT {test} AS held").first()["held"] is False
    spark.createDataFrame([(user, group)], "user_name string, group_name string").createOrReplaceTempView("`odd members`")
    assert spark.sql(f"SELECT {test} AS held").first()["held"] is True


def test_views_over_odd_names(spark):
    spark.sql("SELECT 1 AS `a b`, 2 AS `c``d`").createOrReplaceTempView("`odd source`")
    gov.create_mask_function(spark, "odd mask", "a b", "INT")
    gov.create_masked_view(spark, "odd view", "odd source", {"a b": "odd mask"}, "FALSE")
    assert [tuple(row) for row in spark.table("`odd view`").collect()] == [(gov.MASK_TEXT, 2)]
    gov.create_filtered_view(spark, "odd rows", "odd source", "FALSE", "`a b` > 1")
    assert spark.table("`odd rows`").count() == 0
