from pyspark.sql import functions as F

from lakeloom.operators import skew
from lakeloom.session import ADAPTIVE_OFF, conf_scope
from tests.conftest import rows_of


def _fact(spark, n=40_000):
    """Half of the rows have key 7, a tenth key 8, some none."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 1000 == 3, F.lit(None))
        .otherwise(F.col("id") % 500).cast("int").alias("k"), "id")


def test_hot_keys_are_found(spark):
    assert skew.hot_keys(_fact(spark), "k", share=0.05) == [7, 8]
    assert skew.hot_keys(_fact(spark), "k", share=0.3) == [7]
    assert skew.hot_keys(_fact(spark).where("k = 12345"), "k") == []


def test_salted_join_is_the_join(spark):
    fact = _fact(spark)
    other = spark.range(0, 500).selectExpr("int(id) AS k", "id * 2 AS twice").unionAll(spark.sql("SELECT 7 AS k, 1L AS twice"))
    hot = skew.hot_keys(fact, "k", share=0.05)
    assert rows_of(skew.join_salted(fact, other, "k", hot)) == rows_of(fact.join(other, "k"))
    assert rows_of(skew.join_salted(fact, other, "k", [])) == rows_of(fact.join(other, "k"))


def test_no_task_gets_the_hot_key_alone(spark):
    fact, other = _fact(spark), spark.range(0, 500).selectExpr("int(id) AS k", "id AS w")
    with conf_scope(spark, {**ADAPTIVE_OFF, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}):
        def largest(joined):
            sizes = sorted(row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]

        assert largest(fact.join(other, "k")) > 5
        assert largest(skew.join_salted(fact, other, "k", [7, 8], salts=64)) < 2
