"""The pipeline, stage by stage on each one's own input."""

import pytest

import corpus_pipeline
from lakeloom.llm import mixing, toxicity
from tests.llm.conftest import SF
from tests.llm.test_native import brute_lines
from tests.llm.test_near_dedup import brute


@pytest.fixture(scope="module")
def stages(spark, documents):
    out, docs = [documents], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def texts(frame):
    return {row.doc_id: row.text for row in frame.select("doc_id", "text").collect()}


def test_columns(stages, documents):
    for docs in stages[:-1]:
        assert docs.dtypes == documents.dtypes
    assert stages[-1].columns == [*documents.columns, "ids", "n_byte_ids", "exact"]


def test_toxic_documents_go(spark, stages):
    model = toxicity.learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {row.doc_id: row.score for row in toxicity.score_documents(stages[0], model).collect()}
    assert texts(stages[1]) == {i: text for i, text in texts(stages[0]).items() if scores[i] < 0.7}


def test_lines(stages):
    before = texts(stages[1])
    cut = brute_lines(before.items())
    assert texts(stages[2]) == {i: text for i, text in cut.items() if text.strip() or text == before[i]}
    assert all(row.n_chars == len(row.text) for row in stages[2].collect() if row.text != before[row.doc_id])


def test_one_of_each_group(stages):
    before = texts(stages[2])
    kept = brute(list(before.items()))
    assert texts(stages[3]) == {i: text for i, text in before.items() if kept[i][2]}


def test_mix_and_tokens_keep_all(stages):
    assert texts(stages[4]) == texts(stages[3]) == texts(stages[5])
    assert stages[5].where("not exact").count() == 0


def test_the_mix_reaches_the_result(spark, stages):
    """Rows come in order of the mix, however the files are split."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = corpus_pipeline.run(spark, SF).select("doc_id", "position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    mixed = mixing.mix(stages[3].select("doc_id", "source")).orderBy("position")
    assert [tuple(row) for row in rows] == [tuple(row) for row in mixed.select("doc_id", "position").collect()]


def test_odd_rows(spark, odd_docs, no_docs):
    for start in (odd_docs, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), "odd")
            assert set(start.columns) - {"ids"} <= set(docs.columns)
    assert docs.count() == 0


def test_emptied_documents_go_and_empty_ones_stay(spark):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, ""), (4, None), (5, " \n \n ")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars int")
    assert sorted(row.doc_id for row in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()) == [1, 3, 4, 5]
