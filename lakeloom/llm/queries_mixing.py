"""Query of source mixing."""

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import mixing
from lakeloom.llm.registry import register, table


@register()
def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
