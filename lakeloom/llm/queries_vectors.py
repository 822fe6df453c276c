"""Query of near-duplicate vectors."""

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.registry import register, table
from lakeloom.llm.sign_hash import near_vectors


@register()
def op11_sign_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
