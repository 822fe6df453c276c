"""Query of near-duplicate detection."""

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.near_dedup import near_duplicates
from lakeloom.llm.registry import register, table


@register()
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=75)
