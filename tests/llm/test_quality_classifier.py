"""Held-out accuracy, shrinkage of sparse sites, and defined results for odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality_classifier, toxicity
from tests.llm.conftest import SF


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = toxicity.held_out(F.col("doc_id"))
    judged = quality_classifier.classify(docs, labels, usable=~out).join(labels, "doc_id").where(out).toPandas()
    assert judged.kept[judged.quality == 1].mean() > 0.99
    assert judged.kept[judged.quality == 0].mean() < 0.1


def test_posteriors_match_plain_sums(spark):
    random = np.random.default_rng(1)
    rows = [(h, f"{h}-{p}", float(np.clip(random.normal(0.3 + 0.2 * k, 0.1), 0.01, 0.99)))
            for k, h in enumerate(("a", "b", None)) for p in range(3) for _ in range(20 + 5 * p)]
    sites = quality_classifier.score_sites(spark.createDataFrame(rows, "host string, path string, p double")).collect()
    assert len(sites) == 9
    host = {h: [p for one, _, p in rows if one == h] for h in ("a", "b", None)}
    everything = [p for *_, p in rows]
    means = {h: np.mean(v) for h, v in host.items()}
    between = sum(len(v) * means[h] ** 2 for h, v in host.items()) / len(rows) - np.mean(everything) ** 2 - sum(
        np.var(v) for v in host.values()) / len(rows)
    prior = np.mean(everything)
    for row in sites:
        assert row.host_s == pytest.approx(sum(host[row.host])) and row.host_n == len(host[row.host])
        assert row.prior == pytest.approx(prior)
        assert row.host_strength == pytest.approx(max(prior * (1 - prior) / between - 1, 1.0), rel=1e-6)


def _strength(spread, mean):
    return min(max(mean * (1 - mean) / max(spread, 1e-9) - 1, 1.0), 1e4)


def _between(values, sites):
    """Variance between site means beyond what their sizes explain."""
    members = [values[sites == site] for site in sorted(set(sites))]
    weights = np.array([len(one) for one in members]) / len(values)
    means, noise = np.array([one.mean() for one in members]), np.array([one.var() / len(one) for one in members])
    return max((weights * means ** 2).sum() - values.mean() ** 2 - (weights * noise).sum(), 0.0)


def test_scores_match_brute_force(spark, documents):
    """Every posterior summed anew over all other rows of the site, and every score from it."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 7 != 0, F.col("source")))
    got = quality_classifier.classify(docs, labels).join(docs.select("doc_id", "source", "lang"), "doc_id").toPandas()
    assert len(got) == documents.count()
    p = got.evidence.to_numpy()
    host = np.array([str(value) for value in got.source])
    path = np.array([f"{one}/{two}" for one, two in zip(host, got.lang)])
    prior = p.mean()
    of_hosts, of_paths = _between(p, host), _between(p, path)
    host_strength, path_strength = _strength(of_hosts, prior), _strength(max(of_paths - of_hosts, 0.0), prior)

    def logit(value):
        value = min(max(value, quality_classifier.SMALL), 1 - quality_classifier.SMALL)
        return np.log(value / (1 - value))

    for k, row in enumerate(got.itertuples()):
        others = np.arange(len(p)) != k
        same_host, same_path = p[others & (host == host[k])], p[others & (path == path[k])]
        of_host = (prior * host_strength + same_host.sum()) / (host_strength + len(same_host))
        of_path = (of_host * path_strength + same_path.sum()) / (path_strength + len(same_path))
        score = 1 / (1 + np.exp(-(logit(p[k]) - logit(prior) + logit(of_path))))
        assert (row.host_posterior, row.path_posterior, row.score) == pytest.approx((of_host, of_path, score), rel=1e-6)
        assert row.kept == (row.score >= 0.5)


def test_evidence_is_the_best_logistic_fit():
    """The penalised loss has no slope at the weights found."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 7))
    y = (x @ draw.normal(size=7) + draw.normal(size=400) > 0).astype(float)
    w = quality_classifier.fit_logistic(x, y)
    held = np.hstack([x, np.ones((400, 1))])
    slope = held.T @ (1 / (1 + np.exp(-held @ w)) - y) + np.append(np.ones(7), 1e-6) * w
    assert np.abs(slope).max() < 1e-6


def test_sparse_sites_shrink(spark):
    good, bad = "The quick tea is fine, and we walk on in the sun today.", "### ### $$$ $$$ %%% ###"
    rows = [(k, good if k % 2 else bad, "big" if k < 300 else "good" if k % 2 else "bad", "p") for k in range(600)]
    rows += [(1000, good, "bad", "q"), (1001, good, "alone", "q"), (1002, good, "good", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 600)], "doc_id long, quality int")
    score = {row.doc_id: row for row in quality_classifier.classify(docs, labels).collect()}
    assert score[1000].path_posterior < score[1001].path_posterior < score[1002].path_posterior
    assert score[1001].path_posterior == pytest.approx(0.5, abs=0.05)
    assert score[1000].score < score[1001].score < score[1002].score


def test_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(0, 1), (4, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = quality_classifier.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= row.score <= 1 for row in rows)
    assert quality_classifier.classify(no_docs, labels).count() == 0
    assert quality_classifier.classify(odd_docs, labels.limit(0)).count() == odd_docs.count()
