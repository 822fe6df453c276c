"""Recall against brute force, and defined results for odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import neighbours

def near(table):
    return neighbours.nearest(table, F.col("vec_id") % 20 == 0)


def brute(ids, vectors, queries, top=20):
    out = {}
    for query in queries:
        score = vectors @ vectors[ids == query][0]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != query][:top]
        out[query] = [(int(ids[k]), float(score[k])) for k in order]
    return out


def found(frame):
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_query_matches_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.toPandas()
    ids, vectors = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(np.float64)
    got, want = found(near(table)), brute(ids, vectors, ids[ids % 20 == 0])
    assert got.keys() == want.keys() and recall(got, want) >= 0.97
    for query in want:
        assert len(got[query]) == 20
        assert [s for _, s in got[query]] == sorted((s for _, s in got[query]), reverse=True)


def test_graph_and_search_over_many_leaves(spark, monkeypatch):
    """Norms differ, so the largest product is not the smallest angle."""
    monkeypatch.setattr(neighbours, "LEAF", 64)
    random = np.random.default_rng(4)
    vectors = random.standard_normal((1500, 12)) * random.uniform(0.5, 2, (1500, 1))
    table = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    ids = np.arange(1500)
    want = brute(ids, vectors, ids[ids % 20 == 0])
    got = found(near(table))
    assert recall(got, want) >= 0.9
    for query in want:
        for vec_id, score in got[query]:
            assert score == pytest.approx(float(vectors[vec_id] @ vectors[query]), rel=1e-12)


def test_a_few_very_long_vectors(spark, monkeypatch):
    """Three vectors 100 times as long as the rest leave the others' order alone."""
    monkeypatch.setattr(neighbours, "LEAF", 64)
    random = np.random.default_rng(8)
    vectors = random.standard_normal((1500, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[[3, 501, 1001]] *= 100
    table = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(vectors)], "vec_id long, embedding array<double>")
    ids = np.arange(1500)
    want = brute(ids, vectors, ids[ids % 20 == 0])
    assert recall(found(near(table)), want) >= 0.9


def test_copies_ties_and_unusable_rows(spark):
    random = np.random.default_rng(6)
    rows = [(k, [1.0, 0.0, 0.5]) for k in range(0, 120)]
    rows += [(k, random.standard_normal(3).tolist()) for k in range(120, 200)]
    rows += [(0, [1.0, 0.0, 0.5]), (None, [1.0, 1.0, 1.0]), (220, None), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 0.0]),
             (280, [float("nan"), 1.0, 0.0]), (300, [float("inf"), 1.0, 0.0]), (320, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, node string, score double")
    ids = np.arange(200)
    vectors = np.array([v for _, v in rows[:200]])
    got, want = found(near(table)), brute(ids, vectors, ids[ids % 20 == 0])
    assert got.keys() == want.keys()
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)


def test_few_rows_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], kind)
    assert {q: [i for i, _ in v] for q, v in found(near(three)).items()} == {0: [1, 2]}
    assert near(spark.createDataFrame([(0, [1.0])], kind)).count() == 0
    assert near(spark.createDataFrame([], kind)).count() == 0
