"""Query of vector code compression, and its SQL."""

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.llm import codes
from lakeloom.llm.registry import register, table


def checksum(books: codes.Codebooks) -> str:
    numbers = [str(int(x)) for book in books.books for entry in book for x in entry]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _near(book: str) -> str:
    """Distance and entry of each part as one number: distance times 64 plus entry."""
    terms = " + ".join(f"(v[{k}] - w[{k}]) * (v[{k}] - w[{k}])" for k in range(1, 5))
    return f"SELECT vec_id, label, p, v, min(({terms}) * 64 + e) AS m FROM parts JOIN {book} USING (p) GROUP BY ALL"


def _moved(book: str, near: str) -> str:
    means = ", ".join(f"(s{k} - ((s{k} % n) + n) % n) // n" for k in range(1, 5))
    sums = ", ".join(f"sum(v[{k}])::BIGINT AS s{k}" for k in range(1, 5))
    return f"""SELECT p, e, CASE WHEN n IS NULL THEN w ELSE [{means}] END AS w FROM {book} LEFT JOIN (
        SELECT p, m % 64 AS e, count(*) AS n, {sums} FROM {near} GROUP BY ALL) USING (p, e)"""


SQL = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 256) AS BIGINT)) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, c[p * 4 + 1:p * 4 + 4] AS v FROM kept, range(16) AS t(p)),
seeds AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, c FROM kept QUALIFY e < 64),
book0 AS (SELECT p, e, c[p * 4 + 1:p * 4 + 4] AS w FROM seeds, range(16) AS t(p)),
near0 AS ({_near("book0")}),
book1 AS ({_moved("book0", "near0")}),
near1 AS ({_near("book1")}),
book2 AS ({_moved("book1", "near1")}),
near2 AS ({_near("book2")}),
coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', m % 64), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error
    FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""


@register(SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                        F.lit(checksum(books)).alias("codebooks_sha256"))
