"""Held-out accuracy, the noisy-or, and where sentences stand."""

import os
import zlib

import numpy as np
import pytest

from lakeloom.llm import toxicity


@pytest.fixture(scope="module")
def model():
    clean = [f"The {a} tea is fine today. We like {b} walks." for a in ("green", "black", "cold") for b in ("long", "short", "slow")] * 60
    toxic = [f"{text} You {word}!" for text, word in zip(clean, ("grumpft", "grumpfig", "zork") * 30)]
    return toxicity.fit(clean + toxic, np.array([0] * len(clean) + [1] * len(toxic)))


def test_finds_the_sentence(spark, model):
    text = "Ä nice day here. Such a zork he is. All is well."
    row = toxicity.score_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.score > 0.7
    assert [text[span.start:span.end] for span in row.offending] == ["Such a zork he is"]


def test_word_parts_carry_over(spark, model):
    docs = spark.createDataFrame([(1, "What a grumpfling."), (2, "What a fine tea.")], "doc_id long, text string")
    score = {row.doc_id: row.score for row in toxicity.score_documents(docs, model).collect()}
    assert score[1] > 0.7 > 0.1 > score[2]


def test_noisy_or(model):
    import pyarrow as pa

    score, _, _, chance, _ = toxicity._score_part(pa.array(["A zork. A tea. A grumpft."]), model)
    assert score[0] == pytest.approx(1 - np.prod(1 - chance))


def test_odd_rows(odd_docs, no_docs, model):
    rows = toxicity.score_documents(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= row.score <= 1 for row in rows)
    assert all(row.score == 0 and not row.offending for row in rows if row.doc_id in (3, 4, 5))
    assert toxicity.score_documents(no_docs, model).count() == 0
    assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.without_toxic(odd_docs, model).count() == odd_docs.count()


def test_without_labels(no_docs, odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd_docs, none)
    assert toxicity.without_toxic(odd_docs, model).count() == odd_docs.count()
    nulls = spark.createDataFrame([(None, None, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.learn(no_docs, nulls).bias < 0


def test_fits_in_a_task(spark, monkeypatch):
    """Fitting takes many times its texts; the driver, whose memory is short, gets the model alone."""
    driver, fit = os.getpid(), toxicity.fit

    def away(*given):
        assert os.getpid() != driver, "fitted on the driver"
        return fit(*given)

    rows = [(k, f"The {k % 7} tea is fine. " + ("You zork!" if k % 2 else "We walk."), k % 2) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    known = [row for row in rows if zlib.crc32(str(row[0]).encode()) % 3 != 1]
    expected = fit([text for _, text, _ in known], np.array([toxic for *_, toxic in known]))
    monkeypatch.setattr(toxicity, "fit", away)
    model = toxicity.learn(frame.select("doc_id", "text").repartition(5), frame.select("doc_id", "toxic"), per_class=10_000)
    assert np.array_equal(model.weights, expected.weights) and model.bias == expected.bias


def test_held_out(spark):
    docs = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "doc_id long")
    for row in docs.select("doc_id", toxicity.held_out(docs.doc_id).alias("out")).collect():
        assert row.out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    judged = toxicity.score_documents(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").where(
        toxicity.held_out(labels.doc_id)).select("score", "toxic").toPandas()
    caught = judged.score >= toxicity.THRESHOLD
    assert caught[judged.toxic == 1].mean() > 0.85
    assert caught[judged.toxic == 0].mean() < 0.02
