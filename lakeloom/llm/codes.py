"""Vector code compression: product codes found by a walk over a trie of parts.

Vectors become integers and are cut into consecutive parts. Each part position has a
codebook; a vector's code names the nearest entry of each. Distinct parts in order
form a trie: parts that begin with the same components share a prefix, and the walk
adds up the distances of a prefix to all entries once for all parts below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import require, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Integers are held to this size, so that sums of squares fit 64 bits.
LARGEST = 1 << 27
#: Nodes of one depth that the walk opens at once.
WIDTH = 4096


class Codebooks(NamedTuple):
    """Per part position an integer matrix, one row an entry."""

    length: int
    books: list[np.ndarray]

    @property
    def cuts(self) -> list[tuple[int, int]]:
        return cuts(self.length, len(self.books))


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and end of each part; equal where the length allows it."""
    ends = [part * length // parts for part in range(parts + 1)]
    return list(zip(ends[:-1], ends[1:]))


def nearest_entries(parts: np.ndarray, book: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of distinct parts in ascending order.

    The trie is kept as the first row of each node, by depth. The walk goes depth
    first over runs of at most ``width`` nodes: a run's distances are those of the
    nodes above plus one component's, and its children come before its neighbours.
    """
    count, depth = parts.shape
    best, least = np.zeros(count, np.int64), np.zeros(count, np.int64)
    if not count or not depth:
        return best, least
    new = np.ones((count, depth), bool)
    new[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)
    firsts = [np.flatnonzero(new[:, level]) for level in range(depth)]

    def runs(level: int, low: int, high: int, above: np.ndarray, parent: np.ndarray) -> list[tuple]:
        spans = [(at, min(at + width, high)) for at in range(low, high, width)]
        return [(level, start, stop, above, parent[start - low:stop - low]) for start, stop in reversed(spans)]

    top = len(firsts[0])
    stack = runs(0, 0, top, np.zeros((1, len(book)), np.int64), np.zeros(top, np.int64))
    while stack:
        level, low, high, above, parent = stack.pop()
        rows = firsts[level][low:high]
        here = above[parent] + (parts[rows, level][:, None] - book[:, level]) ** 2
        if level == depth - 1:
            chosen = here.argmin(axis=1)
            best[rows], least[rows] = chosen, here[np.arange(len(rows)), chosen]
            continue
        end = firsts[level][high] if high < len(firsts[level]) else count
        below = firsts[level + 1]
        first, last = np.searchsorted(below, (rows[0], end))
        stack += runs(level + 1, first, last, here, np.searchsorted(rows, below[first:last], "right") - 1)
    return best, least


def distinct_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in ascending order, and which of them each row is."""
    if not values.shape[1]:
        return values[:1], np.zeros(len(values), np.int64)
    order = np.lexsort(values.T[::-1])
    ranked = values[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def _matrix(lists: pa.Array, length: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.int64).reshape(len(lists), length)


def integers(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Usable rows with their vector as integers: floor of ``scale`` times each
    component. Rows go whose vector is null or holds null or non-finite components."""
    column = F.col(vector).cast("array<double>")
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    return rows.where(column.isNotNull() & ~odd).withColumn(vector, F.transform(column, whole))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of integer vectors (columns id, vector).

    They begin as the parts of the ``entries`` smallest ids (ties by vector, null ids
    last). Each round gives every part its nearest entry, ties to the lower one, and
    moves an entry to the floor of the mean of its parts; unused entries stay. Rounds
    read distinct parts with their counts; each task returns one sum an entry.
    The length of the first vector counts; others take no part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is written as two hex digits")
    ranked = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector")
    seeds = [row.vector for row in ranked.limit(entries).collect()]
    length = len(seeds[0]) if seeds else 0
    if any(len(seed) != length for seed in seeds):
        seeds = [row.vector for row in ranked.where(F.size("vector") == length).limit(entries).collect()]
    first = np.array(seeds, np.int64).reshape(len(seeds), length)
    books = Codebooks(length, [first[:, start:end].copy() for start, end in cuts(length, parts)])
    if not seeds:
        return books
    pieces = F.array(*[F.slice("vector", start + 1, end - start) for start, end in books.cuts])
    distinct = stored(
        vectors.where(F.size("vector") == length).select(F.posexplode(pieces).alias("part", "piece"))
        .groupBy("part", "piece").agg(F.count("*").alias("n")).sortWithinPartitions("part", "piece"), "code-parts")
    for _ in range(rounds):
        sums = distinct.mapInArrow(_sums(books), "part int, entry int, n long, totals array<long>")
        means = sums.select("part", "entry", "n", F.posexplode("totals").alias("at", "total")).groupBy(
            "part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for row in means.collect():  # at most entries times length
            books.books[row.part][row.entry, row.at] = int(row.total) // row.n
    return books


def _sums(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros_like(book) for book in books.books]
        used = [np.zeros(len(book), np.int64) for book in books.books]
        for batch in batches:
            number, weight = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for part in np.unique(number):
                at = np.flatnonzero(number == part)
                book = books.books[part]
                pieces = _matrix(batch.column(1).take(pa.array(at)), book.shape[1])
                order = np.lexsort(pieces.T[::-1]) if book.shape[1] else np.arange(len(at))
                pieces, counts = pieces[order], weight[at][order]
                best, _ = nearest_entries(pieces, book)
                np.add.at(totals[part], best, pieces * counts[:, None])
                np.add.at(used[part], best, counts)
        rows = [(part, entry) for part, counts in enumerate(used) for entry in np.flatnonzero(counts)]
        yield pa.RecordBatch.from_arrays([
            pa.array([part for part, _ in rows], pa.int32()), pa.array([entry for _, entry in rows], pa.int32()),
            pa.array([used[part][entry] for part, entry in rows], pa.int64()),
            pa.array([totals[part][entry] for part, entry in rows], pa.list_(pa.int64())),
        ], ["part", "entry", "n", "totals"])
    return run


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Codes of integer vectors of the codebooks' length (columns id, vector, label):
    id, label, code (one byte a part) and error, the squared distances to the entries
    named. One pass without a shuffle; a batch's distinct parts form its tries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column(1), books.length)
            code = np.zeros((len(matrix), len(books.books)), np.uint8)
            error = np.zeros(len(matrix), np.int64)
            for part, (start, end) in enumerate(books.cuts):
                pieces, place = distinct_rows(matrix[:, start:end])
                best, least = nearest_entries(pieces, books.books[part])
                code[:, part] = best[place]
                error += least[place]
            packed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(code.shape[1]), len(code), [None, pa.py_buffer(code.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), packed, pa.array(error)], ["id", "label", "code", "error"])

    kinds = {field.name: field.dataType.simpleString() for field in vectors.schema.fields}
    return vectors.where(F.size("vector") == books.length).select("id", "vector", "label").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, code binary, error long")


def decode(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``coded`` with ``vector``: the named entries end to end, back in the scale of
    the input, each component at the middle of the integer's range."""
    entry = [F.array(*[F.array(*[F.lit((int(x) + 0.5) / scale) for x in row]).cast("array<double>") for row in book])
             for book in books.books]
    named = [F.element_at(entry[part], F.conv(F.hex(F.substring("code", part + 1, 1)), 16, 10).cast("int") + 1)
             for part in range(len(books.books))]
    return coded.withColumn("vector", F.concat(*named))


def compress(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Codes of all usable vectors (columns vec_id, label, ``vector``) and the codebooks.

    Returns vec_id, label, code (binary), error and label_error, the errors summed
    over rows of equal label, nulls together (null if the sum passes 64 bits). Rows
    go whose vector is null or holds null or non-finite components, or has another
    length than the vector of the smallest vec_id. A null vec_id is coded, but seeds
    an entry only if ids are too few. Repeated rows count as often as they stand. A
    component beyond 524,288 counts as that. An empty table gives no rows. Other
    columns are ignored.
    """
    require(rows, "vec_id", "label", vector)
    vectors = stored(integers(rows.select("vec_id", "label", vector), vector).select(
        F.col("vec_id").alias("id"), "label", F.col(vector).alias("vector")), "code-vectors")
    books = train(vectors, parts, entries, rounds)
    coded = stored(encode(vectors, books), "code-coded")
    totals = stored(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
                    .select(F.col("label").alias("of"), F.expr("try_cast(total AS bigint)").alias("label_error")), "code-totals")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"), "label", "code", "error", "label_error"), books
