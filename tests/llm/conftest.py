from __future__ import annotations

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = " ".join(f"w{i}" for i in range(40_000))
TEXTS = [
    "alpha beta gamma delta epsilon zeta eta theta", "alpha beta gamma delta epsilon zeta eta theta",
    "ALPHA  beta\tgamma delta epsilon zeta eta theta", None, "", " \n\t ", "one two", "one two", "é ☃ 𝒳 ok", LONG,
    "a line\nb line\nc line\nd line", "x\na line\nb line\nc line\ny",
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept string, slot int, ids string, "
          "name string, first int, component_id int")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, a repeated row, clashing names."""
    rows = [(k, text, "en" if k % 2 else None, "s0" if k % 3 else None, None if text is None else len(text),
             0.5, "k", 3, "i", "n", 1, 9) for k, text in enumerate(TEXTS)]
    rows += [rows[0], (None, TEXTS[0], "en", "s0", 1, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
