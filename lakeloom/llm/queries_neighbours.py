"""Query of nearest neighbours."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm.neighbours import nearest
from lakeloom.llm.registry import register, table


@register()
def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)
