"""Quality by hierarchical empirical Bayes.

A logistic classifier on text statistics gives each document's evidence. Hosts and
their paths get posteriors: the mean evidence of their documents, shrunk towards
the level above by as many pseudo-documents as the spread between sites calls for.
A document's score joins its evidence with the posterior of its path, computed
without the document itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require, stored
from lakeloom.llm.text_stats import text_stats

SMALL = 1e-4


def _features() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    letters = F.greatest("word_chars", F.lit(1))
    return {
        "few_words": F.least(F.log1p("n_words") / 4, F.lit(1.0)),
        "word_length": F.least(F.log(F.greatest(F.col("word_chars") / words, F.lit(1.0))), F.lit(4.0)),
        "symbols": F.sqrt(F.col("n_symbols") / (letters + 20)),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 3)),
        "repeats": F.sqrt(F.col("n_repeat_words") / (words + 20)),
        "capitals": F.sqrt(F.col("n_upper") / (letters + 20)),
        # Texts repeat words the more the longer they are: about as a power of the length.
        "variety": F.log((F.col("n_distinct") + 5) / F.pow(words + 5.0, F.lit(0.85))),
    }


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, by damped Newton steps with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(SMALL)), F.lit(1 - SMALL))
    return F.log(p / (1 - p))


def learn(stats: DataFrame, labels: DataFrame, sample: int = 20_000, usable: Column | None = None) -> dict[str, float]:
    """Classifier weights from about ``sample`` labelled rows, chosen by a hash of
    doc_id. Rows come as a few numbers each; ``sample`` bounds what is collected. A
    document labelled low once counts as low. Without both labels the evidence is the
    base rate alone."""
    require(labels, "doc_id", "quality")
    known = labels.where("doc_id is not null and quality is not null")
    known = (known.where(usable) if usable is not None else known).groupBy("doc_id").agg(
        F.min(F.col("quality").cast("int")).alias("quality"))
    size = max(1, known.count())
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    names = list(_features())
    rows = stats.join(known.where(chance < sample / size).limit(2 * sample), "doc_id").select(
        "doc_id", *names, "quality").limit(4 * sample).toPandas().sort_values("doc_id")
    y = rows["quality"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return {**dict.fromkeys(names, 0.0), "constant": 0.0 if not len(y) else 3.0 * (2 * y[0] - 1)}
    return dict(zip([*names, "constant"], fit_logistic(rows[names].to_numpy(np.float64), y).tolist()))


def _strength(spread: Column, mean: Column) -> Column:
    """Pseudo-documents of a beta prior whose means vary by ``spread``; steady sites
    shrink fully (a large number), wildly different ones hardly."""
    return F.least(F.greatest(mean * (1 - mean) / F.greatest(spread, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e4))


def score_sites(evidence: DataFrame) -> DataFrame:
    """Posteriors of hosts and paths from rows (host, path, p): one row a path, with
    count, sum, the host's posterior without weight on this path, and the strengths.

    Sums are grouped by path first, so a hot host is a few rows when it is joined.
    """
    paths = stored(evidence.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss")), "quality-paths")
    hosts = paths.groupBy("host").agg(*[F.sum(name).alias(f"host_{name}") for name in ("n", "s", "ss")])

    def spread(sites: DataFrame, n: str, s: str, ss: str, label: str) -> DataFrame:
        """Variance between site means beyond what their sizes explain."""
        mean = F.col(s) / F.col(n)
        noise = F.greatest(F.col(ss) / F.col(n) - mean * mean, F.lit(0.0)) / F.col(n)
        total = F.sum(s) / F.sum(n)
        between = F.sum(F.col(n) * mean * mean) / F.sum(n) - total * total - F.sum(F.col(n) * noise) / F.sum(n)
        return sites.agg(total.alias(f"{label}_mean"), F.greatest(between, F.lit(0.0)).alias(f"{label}_spread"))

    overall = spread(hosts, "host_n", "host_s", "host_ss", "host").first().asDict()
    overall |= spread(paths, "n", "s", "ss", "path").first().asDict()
    prior = overall["host_mean"] if overall["host_mean"] is not None else 0.5
    if overall["host_mean"] is None:
        overall = {"host_mean": prior, "host_spread": 0.0, "path_mean": prior, "path_spread": 0.0}
    host_strength = _strength(F.lit(overall["host_spread"]), F.lit(prior))
    path_strength = _strength(F.lit(max(overall["path_spread"] - overall["host_spread"], 0.0)), F.lit(prior))
    named = hosts.withColumnRenamed("host", "of_host")
    return paths.join(named, F.col("host").eqNullSafe(F.col("of_host"))).select(
        "host", "path", "n", "s", "host_n", "host_s", F.lit(prior).alias("prior"),
        host_strength.alias("host_strength"), path_strength.alias("path_strength"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", usable: Column | None = None,
             cutoff: float = 0.5) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, score, kept: one row a row of ``docs``.

    Both posteriors leave the row itself out. Null host or path is a value of its
    own. Null and empty texts are scored by their statistics, all zero. Rows that
    repeat a doc_id are scored each. Other columns are ignored.
    """
    require(docs, "doc_id", "text", host, path)
    plain = docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), "text")
    stats = stored(text_stats(plain, "doc_id", "host", "path").select(
        "doc_id", "host", "path", *[value.cast("double").alias(name) for name, value in _features().items()]), "quality-stats")
    weights = learn(stats, labels, usable=usable)
    score = sum((F.col(name) * weights[name] for name in _features()), F.lit(weights["constant"]))
    rows = stats.withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest(score, F.lit(-30.0)), F.lit(30.0))))).select(
        "doc_id", "host", "path", "p")
    sites = score_sites(rows).withColumnsRenamed({"host": "site_host", "path": "site_path"})
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")))
    host_posterior = (F.col("prior") * F.col("host_strength") + F.col("host_s") - F.col("p")) / (
        F.col("host_strength") + F.col("host_n") - 1)
    path_posterior = (F.col("host_posterior") * F.col("path_strength") + F.col("s") - F.col("p")) / (
        F.col("path_strength") + F.col("n") - 1)
    total = _logit(F.col("p")) - _logit(F.col("prior")) + _logit(F.col("path_posterior"))
    return joined.withColumn("host_posterior", host_posterior).withColumn("path_posterior", path_posterior).select(
        "doc_id", F.col("p").alias("evidence"), "host_posterior", "path_posterior",
        (1 / (1 + F.exp(-total))).alias("score")).withColumn("kept", F.col("score") >= cutoff)
