"""Queries of document quality: toxicity, quality rules, quality classifier."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm import quality_classifier, quality_rules, toxicity
from lakeloom.llm.registry import register, table


@register()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "offending")


@register()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@register()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels that the toxicity split does not hold out either."""
    unseen = ~toxicity.held_out(F.col("doc_id"))
    return quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable=unseen).withColumn(
        "held_out", toxicity.held_out(F.col("doc_id")))
