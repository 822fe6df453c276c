"""Query of conversation repair: damage done by a hash of the row, then mended."""

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm import repair
from lakeloom.llm.registry import register, table


def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of ends of sentences, repeated or given to the
    user, by a hash of conversation and turn."""
    said = conversations.select("conv_id", "turn", *[F.coalesce(F.col(name), F.lit(" ")).alias(name) for name in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    dice = F.col("dice")
    return said.withColumn("dice", F.crc32(key) % 20).where(dice != 0).select(
        "conv_id", "turn", F.when(dice == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(dice == 1, "").when(dice == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(dice == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@register()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    mended = repair.repair(damage(conversations))
    every = conversations.select("conv_id").distinct()
    sums = mended.summary.withColumnRenamed("conv_id", "of")
    hashes = repair.fingerprints(mended.rows).withColumnRenamed("conv_id", "hashed")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(sums, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left").select(
        "conv_id", *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
