"""The corpus pipeline: toxicity, line dedup, near dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Each result is written as Parquet and read again.
``run`` also keeps each document's place in the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm import line_dedup, mixing, near_dedup, pieces, toxicity
from lakeloom.llm.common import stored
from lakeloom.llm.queries_tokens import MODEL
from lakeloom.llm.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the labels."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines; n_chars follows. A document goes if it
    loses lines and no word is left; one that was empty before stays."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(
            F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return left.select(*[F.col(f"`{name}`") for name in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; rows without doc_id stay."""
    judged = near_dedup.near_duplicates(docs)
    copies = stored(judged.where(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    return docs.join(copies.hint("shuffle_hash"), "doc_id", "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])


def with_positions(docs: DataFrame) -> DataFrame:
    """All documents with ``position``, their place in the mix: sources interleave in
    blocks by target weights, sizes to the power of 0.7."""
    packed = docs.select("doc_id", "source", F.struct(
        *[F.col(f"`{name}`") for name in docs.columns if name != "position"]).alias("row"))
    return mixing.mix(packed).select("row.*", "position")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow the mix."""
    packed = docs.select("doc_id", "source", F.struct("*").alias("row"))
    return mixing.in_order(mixing.mix(packed)).select("row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token ids, and whether they decode to the text."""
    return pieces.encode(docs, pieces.load(MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Learned weights and Viterbi paths cannot be said in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn. Files alone do not hold an order once they are read in
    splits, so the mix goes on as a column: the result has ``position``, is written in
    its order and sorted by it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        step = with_positions(docs) if stage is mix_sources else stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            step = step.repartitionByRange("position").sortWithinPartitions("position")
        docs = stored(step, f"pipeline-{name}")
    return docs.orderBy("position")
