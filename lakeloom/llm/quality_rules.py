"""Quality rules by robust multivariate outliers.

Each text's counts become a vector; per language and source a minimum covariance
determinant estimate gives a centre and a scatter that outliers cannot move;
texts too far away in Mahalanobis distance are rejected.

Every group starts from its medians with three scatters: quartile spans alone, and
spans with the correlations of bounded scores (tanh) or of spatial signs. From each
start, concentration steps follow: the nearest three quarters of a group give the next
centre and scatter, until the determinant falls no more; the estimate with the least
determinant over all starts and steps is kept. Ranks come from histograms of the
distance, so a step is two grouped sums over all rows for all groups and starts at
once, whatever the size of a group; finished ones drop out. Counts that are nearly
always zero have no spread of their own, so each is blurred below one whole count by a
hash of the text's counts, and shares are compared by their logarithms: the scatter of
every axis then comes from the group. Another count of the text also draws the blur
anew: by up to log(51) = 3.9 for a count of zero, which is its axis's whole spread
where zero is usual, and by at most log(2) from a count of one on. Groups with few
rows use their language's estimate, and small languages that of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.llm.common import require, stored
from lakeloom.llm.text_stats import COUNTS, text_stats

AXES = ("word_length", "symbols", "dup_lines", "repeats", "capitals")
#: Spread added to each axis against singular matrices, as where all texts are equal;
#: core spreads on sf0.1 are 0.03 (word length), 0.2 (capitals) and about 1.
FLOORS = (0.01, 0.01, 0.01, 0.01, 0.01)
#: A count n becomes one between n + LEAST and n + 1 + LEAST.
LEAST = 0.02
#: Share of a group that the estimate rests on.
CORE = 0.75
#: Fixed values for five axes: the factor that makes the scatter of the nearest 75 %
#: that of a whole normal group, and the 99.99 % point of chi-square.
CONSISTENT = 1.412
CUTOFF = 25.74
#: Histogram steps per doubling of the distance.
FINE = 32
#: A start's steps end when the determinant falls by less than this share.
SETTLED = 1e-3
#: Part of the identity in the correlations of a start, against singular matrices.
RIDGE = 0.01
#: Estimates that may be broadcast (some 200 bytes each), and rows a salted part has.
SHIPPED = 20_000
PART_ROWS = 1_000_000

_N = len(AXES)
_PAIRS = [(i, j) for i in range(_N) for j in range(i, _N)]
_ESTIMATE = [*(f"m{i}" for i in range(_N)), *(f"p{i}{j}" for i, j in _PAIRS)]
_FIT = "group string, start int, determinant double, falls boolean, " + ", ".join(f"{name} double" for name in _ESTIMATE)


def _blurred(count: str, axis: int) -> Column:
    """The count, and a part of one that equal counts of a whole text share."""
    part = F.pmod(F.xxhash64(F.lit(axis), *COUNTS), F.lit(1 << 20)) / float(1 << 20)
    return F.col(count) + part + LEAST


def _vector(stats: DataFrame) -> DataFrame:
    """Transformed statistics: logarithms of word length and of shares. A constant in
    the denominator keeps short texts from extremes."""
    axes = (
        F.log((F.col("word_chars") + 20) / (F.col("n_words") + 4)),
        F.log(_blurred("n_symbols", 1) / (F.col("word_chars") + 20)),
        F.log(_blurred("n_dup_lines", 2) / (F.col("n_lines") + 3)),
        F.log(_blurred("n_repeat_words", 3) / (F.col("n_words") + 20)),
        F.log((F.col("n_upper") + 0.5) / (F.col("word_chars") + 20)),
    )
    return stats.withColumns({f"x{i}": axis.cast("double") for i, axis in enumerate(axes)})


def _distance() -> Column:
    terms = [f"{1 if i == j else 2} * p{i}{j} * (x{i} - m{i}) * (x{j} - m{j})" for i, j in _PAIRS]
    return F.expr(" + ".join(terms))


def _spans(rows: DataFrame) -> DataFrame:
    """Median (m) and quartile span (s) per group and axis, from histograms of fixed width."""
    width = 1 / 256
    cells = rows.select("group", F.posexplode(F.array(*[f"x{i}" for i in range(_N)])).alias("axis", "x")).groupBy(
        "group", "axis", F.floor(F.col("x") / width).alias("cell")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("group", "axis").orderBy("cell")
    ranked = cells.withColumn("upto", F.sum("n").over(upto)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("group", "axis")))
    at = [F.min(F.when(F.col("upto") >= F.col("total") * share, (F.col("cell") + 0.5) * width)) for share in (0.25, 0.5, 0.75)]
    spans = ranked.groupBy("group", "axis").agg(*[value.alias(f"q{k}") for k, value in enumerate(at)])
    spread = F.greatest((F.col("q2") - F.col("q0")) / 1.349, F.element_at(F.array(*map(F.lit, FLOORS)), F.col("axis") + 1))
    return spans.withColumn("spread", spread).groupBy("group").agg(*[
        F.max(F.when(F.col("axis") == i, F.col(value))).alias(f"{name}{i}")
        for name, value in (("m", "q1"), ("s", "spread")) for i in range(_N)])


def _starts(rows: DataFrame, spans: DataFrame, salts: int) -> DataFrame:
    """Three first estimates of every group, from one grouped sum."""
    scaled = _with_fit(rows, spans, "group", salts).withColumns(
        {f"z{i}": (F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}") for i in range(_N)})
    length = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, _N)), F.col("z0") * F.col("z0"))
    scaled = scaled.withColumns({"length": length, **{f"t{i}": F.tanh(f"z{i}") for i in range(_N)}})
    sums = scaled.groupBy("group").agg(
        F.count("*").cast("double").alias("n"),
        *[F.max(f"{name}{i}").alias(f"{name}{i}") for name in ("m", "s") for i in range(_N)],
        *[F.sum(f"t{i}").alias(f"t{i}") for i in range(_N)],
        *[F.sum(F.col(f"t{i}") * F.col(f"t{j}")).alias(f"t{i}{j}") for i, j in _PAIRS],
        *[F.sum(F.when(F.col("length") > 0, F.col(f"z{i}") * F.col(f"z{j}") / F.col("length")).otherwise(0.0)).alias(f"u{i}{j}")
          for i, j in _PAIRS])
    return sums.mapInArrow(_started, _FIT)


def _matrices(values: np.ndarray) -> np.ndarray:
    """Symmetric matrices from the columns of their upper halves."""
    full = np.zeros((len(values), _N, _N))
    for k, (i, j) in enumerate(_PAIRS):
        full[:, i, j] = full[:, j, i] = values[:, k]
    return full


def _estimates(group: pa.Array, start: pa.Array, mean: np.ndarray, scatter: np.ndarray, last: np.ndarray | None) -> pa.RecordBatch:
    """Estimates as rows; without a ``last`` determinant they are starts, and still fall."""
    inverse = np.linalg.inv(scatter)
    found = np.linalg.det(scatter)
    falls = np.ones(len(found), bool) if last is None else found < last * (1 - SETTLED)
    return pa.RecordBatch.from_arrays(
        [group, start, pa.array(found if last is not None else np.full(len(found), np.inf)), pa.array(falls),
         *(pa.array(mean[:, i]) for i in range(_N)), *(pa.array(inverse[:, i, j]) for i, j in _PAIRS)],
        ["group", "start", "determinant", "falls", *_ESTIMATE])


def _started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = len(_PAIRS)
    for batch in batches:
        values = np.stack([np.asarray(column, np.float64) for column in batch.columns[1:]], axis=1)
        n, mean, spread, scores, products, signs = np.split(
            values, np.cumsum([1, _N, _N, _N, pairs]), axis=1)
        alone = np.broadcast_to(np.eye(_N), (len(n), _N, _N))
        bounded = _matrices(products / n) - (scores / n)[:, :, None] * (scores / n)[:, None, :]
        for start, spans in enumerate((alone, bounded, _matrices(signs / n))):
            size = np.sqrt(np.maximum(np.einsum("nii->ni", spans), 1e-12))
            likeness = (1 - RIDGE) * spans / (size[:, :, None] * size[:, None, :]) * (1 - np.eye(_N)) + np.eye(_N)
            yield _estimates(batch.column(0), pa.array(np.full(len(n), start, np.int32)), mean,
                             likeness * spread[:, :, None] * spread[:, None, :], None)


def _concentrated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and scatter from each core's count, sums and products."""
    for batch in batches:
        values = np.stack([np.asarray(column, np.float64) for column in batch.columns[2:]], axis=1)
        last, n, sums, products = np.split(values, np.cumsum([1, 1, _N]), axis=1)
        mean = sums / n
        scatter = _matrices(products / n) - mean[:, :, None] * mean[:, None, :]
        scatter = scatter * CONSISTENT + np.diag(np.square(FLOORS))
        yield _estimates(batch.column(0), batch.column(1), mean, scatter, last[:, 0])


def _with_fit(rows: DataFrame, fits: DataFrame, key: str, salts: int, how: str = "inner") -> DataFrame:
    """Join estimates to rows. A group may hold all rows, so they are never dealt by
    group alone: up to ``SHIPPED`` estimates go to every task, and more are repeated
    for each of ``salts`` parts that the rows are dealt into."""
    if fits.count() <= SHIPPED:
        return rows.join(F.broadcast(fits), key, how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", *[f"x{i}" for i in range(_N)]), F.lit(salts)))
    return salted.join(fits.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), [key, "salt"], how)


def _step(rows: DataFrame, fits: DataFrame, salts: int) -> DataFrame:
    """One concentration step for every group and start at once."""
    cell = F.floor(F.log2(F.greatest(_distance(), F.lit(1e-9))) * FINE)
    near = _with_fit(rows, fits, "group", salts).select(
        "group", "start", "determinant", cell.alias("cell"), *[f"x{i}" for i in range(_N)])
    sums = [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(_N)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _PAIRS]]
    cells = near.groupBy("group", "start", "cell").agg(F.max("determinant").alias("last"), *sums)
    whole = Window.partitionBy("group", "start")
    before = F.sum("n").over(whole.orderBy("cell")) - F.col("n")
    core = cells.withColumn("before", before).withColumn("total", F.sum("n").over(whole)).where(
        F.col("before") < F.col("total") * CORE)
    names = ["n", *[f"s{i}" for i in range(_N)], *[f"s{i}{j}" for i, j in _PAIRS]]
    moments = core.groupBy("group", "start").agg(
        F.max("last").alias("last"), *[F.sum(name).cast("double").alias(name) for name in names])
    return moments.mapInArrow(_concentrated, _FIT)


def least_determinant(rows: DataFrame, salts: int = 1, steps: int = 30) -> DataFrame:
    """The estimate of least determinant of each ``group``: group, determinant, centre
    (m0 ...) and inverse scatter (p00 ...). ``rows`` hold group, doc_id and x0 ...; equal
    determinants go to the earlier start. ``steps`` bounds the steps of a start that
    does not settle before."""
    fits = stored(_starts(rows, stored(_spans(rows), "rules-spans"), salts), "rules-fit")
    seen = None
    for _ in range(steps):
        fits = stored(_step(rows, fits.where("falls"), salts), "rules-fit")
        seen = fits if seen is None else seen.unionByName(fits)
        if not fits.where("falls").limit(1).count():
            break
    best = F.min_by(F.struct("determinant", *_ESTIMATE), F.struct("determinant", "start"))
    return seen.groupBy("group").agg(best.alias("best")).select("group", "best.*")


def judge(docs: DataFrame, steps: int = 30, least: int = 200, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed, distance (squared Mahalanobis), kept: one row a row.

    base_failed: under 50 words, or more than half of the words repeated. Texts that
    fail it take no part in the estimates and are not kept; others are kept within
    ``cutoff``. Null texts have no words. Null language or source is a value of its
    own. Repeated rows count each. Other columns are ignored.
    """
    require(docs, "doc_id", "text", "lang", "source")
    stats = text_stats(docs, "doc_id", "lang", "source")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    language = F.to_json(F.struct("lang"))
    site = F.to_json(F.struct("lang", "source"))
    rows = stored(_vector(stats).select(
        "doc_id", language.alias("language"), site.alias("site"), *COUNTS[:5], failed.alias("base_failed"),
        *[f"x{i}" for i in range(_N)]), "rules-stats")
    sound = rows.where(~F.col("base_failed"))
    axes = [f"x{i}" for i in range(_N)]
    salts = rows.count() // PART_ROWS + 1
    levels = sound.select("doc_id", F.explode(F.array(F.lit("all"), "language", "site")).alias("group"), *axes)
    sizes = sound.groupBy("site", "language").agg(F.count("*").alias("n"))
    by_language = Window.partitionBy("language")
    group = F.when(F.col("n") >= least, F.col("site")).when(
        F.sum("n").over(by_language) >= least, F.col("language")).otherwise("all")
    chosen = sizes.select("site", group.alias("group"))
    fits = least_determinant(levels, salts, steps).drop("determinant")
    by_site = stored(chosen.join(fits, "group").drop("group"), "rules-sites")
    far = _with_fit(rows, by_site, "site", salts, "left").withColumn("distance", _distance())
    return far.select("doc_id", *COUNTS[:5], "base_failed", "distance", F.coalesce(
        ~F.col("base_failed") & (F.col("distance") <= cutoff), F.lit(False)).alias("kept"))
