"""Queries of the operators made of DataFrame functions only."""

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import line_dedup, perspectives, secrets
from lakeloom.llm.registry import register, table


@register(line_dedup.SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@register(secrets.SQL)
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@register(perspectives.SQL)
def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.digest(perspectives.rotate(table(spark, sf_dir, "conversations")))
