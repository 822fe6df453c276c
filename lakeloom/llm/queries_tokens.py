"""Query of SentencePiece encoding and decoding."""

import os

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import pieces
from lakeloom.llm.registry import register, table

#: A public model file; any other path can be given to the operator.
MODEL = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")


@register()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces.load(MODEL))
    return encoded.selectExpr("doc_id", "cast(size(ids) as bigint) as n_ids", "n_byte_ids", "exact", "ids")
