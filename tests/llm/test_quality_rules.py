"""Base counts against plain Python, and the robust estimate against numpy."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality_rules
from lakeloom.llm.text_stats import text_stats


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    covered = {k + step for k, window in enumerate(windows) if windows.count(window) > 1 for step in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


CASES = [
    None, "", " \n \n", "a", "a b a b a b", "a b c\na b c\nx\n\n \na b c", "x y z # y z # y z", "é 𝒳☃ |x|\r\né", "a\x0bb\x0cc\x85d e",
    "l\n l\nl", "a b c d a b c e", "l\n\nl\n", "one two three " * 40,
]


def test_counts_match_plain_python(spark, documents):
    texts = CASES + [row.text for row in documents.orderBy("doc_id").limit(60).collect() if len(row.text) < 6000]
    rows = text_stats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id").collect()
    for row in rows:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute(texts[row.doc_id]), texts[row.doc_id]


def _first(x):
    """Centre and the three first scatters of one group, with numpy."""
    floor = np.array(quality_rules.FLOORS)
    cells = np.floor(x * 256)
    q = []
    for share in (0.25, 0.5, 0.75):
        q.append([(np.sort(column)[int(np.ceil(share * len(x))) - 1] + 0.5) / 256 for column in cells.T])
    spread = np.maximum((q[2] - np.array(q[0])) / 1.349, floor)
    z = (x - q[1]) / spread
    signs = z / np.linalg.norm(z, axis=1)[:, None]
    out = []
    for likeness in (np.eye(5), np.corrcoef(np.tanh(z).T), signs.T @ signs):
        size = np.sqrt(np.diag(likeness))
        likeness = likeness / np.outer(size, size) * (1 - quality_rules.RIDGE)
        np.fill_diagonal(likeness, 1)
        out.append(likeness * np.outer(spread, spread))
    return np.array(q[1]), out


def _concentrate(x, mean, scatter, steps, quantile=quality_rules.CORE):
    """Least determinant, centre and inverse scatter from one start, ranks by the same histogram."""
    floor = np.array(quality_rules.FLOORS)
    inverse, last, best = np.linalg.inv(scatter), np.inf, None
    for _ in range(steps):
        distance = np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)
        cell = np.floor(np.log2(np.maximum(distance, 1e-9)) * quality_rules.FINE)
        cut = np.sort(cell)[int(np.ceil(quantile * len(x))) - 1]
        core = x[cell <= cut]
        mean = core.mean(axis=0)
        scatter = np.cov(core.T, bias=True) * quality_rules.CONSISTENT + np.diag(floor ** 2)
        inverse, found = np.linalg.inv(scatter), np.linalg.det(scatter)
        if best is None or found < best[0]:
            best = found, mean, inverse
        if not found < last * (1 - quality_rules.SETTLED):
            break
        last = found
    return best


def _least(x, steps):
    centre, scatters = _first(x)
    return min((_concentrate(x, centre, scatter, steps) for scatter in scatters), key=lambda fit: fit[0])


def _distances(x, steps):
    _, mean, inverse = _least(x, steps)
    return np.einsum("ni,ij,nj->n", x - mean, inverse, x - mean)


@pytest.mark.parametrize("shipped", [20_000, 0])
def test_distances_match_numpy(spark, documents, monkeypatch, shipped):
    monkeypatch.setattr(quality_rules, "SHIPPED", shipped)
    one = documents.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    got = {row.doc_id: row for row in quality_rules.judge(one, steps=3, least=10).collect()}
    stats = quality_rules._vector(text_stats(one, "doc_id")).toPandas().set_index("doc_id")
    sound = [i for i in stats.index if not got[i].base_failed]
    want = _distances(stats.loc[sound, [f"x{i}" for i in range(5)]].to_numpy(float), 3)
    assert [got[i].distance for i in sound] == pytest.approx(list(want), rel=1e-6, abs=1e-9)
    for i in stats.index:
        failed = stats.n_words[i] < 50 or 100 * stats.n_repeat_words[i] > 50 * stats.n_words[i]
        assert got[i].base_failed == failed
        assert got[i].kept == (not failed and got[i].distance <= quality_rules.CUTOFF)


def _cloud(seed, likeness, far=5.0, rows=600, share=0.2):
    """Rows of equally correlated axes, and a tight group of outliers along the
    narrowest direction, where no axis alone shows them."""
    draw = np.random.default_rng(seed)
    scatter = np.full((5, 5), likeness) + (1 - likeness) * np.eye(5)
    x = draw.multivariate_normal(np.zeros(5), scatter, size=rows)
    out = draw.random(rows) < share
    x[out] = far * np.linalg.eigh(scatter)[1][:, 0] + 0.1 * draw.normal(size=(out.sum(), 5))
    return x, out


def test_least_determinant_of_all_starts(spark):
    """Agrees with numpy per group, and is about as low as a search from 300 random starts."""
    cases = ((0, 0.9), (1, 0.9), (2, 0.9), (0, 0.97), (3, 0.3, 12.0))
    clouds = {f"g{k}": _cloud(*case) for k, case in enumerate(cases)}
    rows = [(name, k, *map(float, row)) for name, (x, _) in clouds.items() for k, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "group string, doc_id long, " + ", ".join(f"x{i} double" for i in range(5)))
    got = {row.group: row for row in quality_rules.least_determinant(frame).collect()}
    assert set(got) == set(clouds)
    for name, (x, out) in clouds.items():
        centre, scatters = _first(x)
        each = [_concentrate(x, centre, scatter, 30)[0] for scatter in scatters]
        assert got[name].determinant == pytest.approx(min(each), rel=1e-6)
        if name != "g4":  # axis spans alone take the outliers for part of the core
            assert min(each) < 0.4 * each[0]
        draw = np.random.default_rng(7)
        search = []
        for _ in range(300):
            picked = x[draw.choice(len(x), 6, replace=False)]
            search.append(_concentrate(x, picked.mean(axis=0), np.cov(picked.T) + 1e-6 * np.eye(5), 30)[0])
        assert got[name].determinant < 1.05 * min(search)
        precision = np.zeros((5, 5))
        for i in range(5):
            for j in range(i, 5):
                precision[i, j] = precision[j, i] = got[name][f"p{i}{j}"]
        away = x - np.array([got[name][f"m{i}"] for i in range(5)])
        distance = np.einsum("ni,ij,nj->n", away, precision, away)
        assert distance[out].min() > quality_rules.CUTOFF
        assert (distance[~out] > quality_rules.CUTOFF).mean() < 0.02


def test_junk_goes_and_clean_text_stays(spark):
    folder = "/root/testdata/sf0.1"
    judged = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").select("quality", "kept").toPandas()
    assert judged.kept[judged.quality == 1].mean() > 0.995
    assert judged.kept[judged.quality == 0].mean() < 0.6


def test_scatter_comes_from_the_data(spark):
    """Tables with some 11 % of "|" go too, and every axis has a spread above its floor."""
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    judged = quality_rules.judge(documents).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").select("quality", "kept").toPandas()
    assert judged.kept[judged.quality == 0].mean() < 0.05
    rows = quality_rules._vector(text_stats(documents, "doc_id", "lang")).where("n_words >= 50 and lang = 'en'").toPandas()
    for axis, floor in enumerate(quality_rules.FLOORS):
        low, high = rows[f"x{axis}"].quantile([0.25, 0.75])
        assert (high - low) / 1.349 > 2 * floor


def test_odd_rows(odd_docs, no_docs):
    rows = quality_rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {row.doc_id: row for row in rows}
    assert by_id[3].n_words == 0 and by_id[3].base_failed and not by_id[3].kept
    assert by_id[9].n_words == 40_000 and by_id[9].kept
    assert quality_rules.judge(no_docs).count() == 0
