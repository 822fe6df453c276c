"""Product codes against a plain loop over all entries."""

import hashlib
import math

import numpy as np
import pytest

from lakeloom.llm import codes
from lakeloom.llm.queries import LLM_REGISTRY
from lakeloom.llm.queries_codes import checksum
from tests.llm.conftest import SF
from tests.oracle import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, part int, n double"


def brute(rows, parts, entries, rounds):
    """Rows are (vec_id, vector, label) in any order."""
    kept = sorted(((i is None, i, [math.floor(np.float64(np.float32(x)) * 256) for x in v], label) for i, v, label in rows
                   if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0], r[1] or 0, r[2]))
    if not kept:
        return {}, ""
    length = len(kept[0][2])
    kept = [row for row in kept if len(row[2]) == length]
    books = [[row[2][a:b] for row in kept[:entries]] for a, b in codes.cuts(length, parts)]

    def near(book, piece):
        return min((sum((x - y) ** 2 for x, y in zip(entry, piece)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(codes.cuts(length, parts), books):
            meets = {}
            for row in kept:
                meets.setdefault(near(book, row[2][a:b])[1], []).append(row[2][a:b])
            for entry, pieces in meets.items():
                book[entry] = [sum(column) // len(pieces) for column in zip(*pieces)]
    out, by_label = [], {}
    for _, i, vector, label in kept:
        found = [near(book, vector[a:b]) for (a, b), book in zip(codes.cuts(length, parts), books)]
        error = sum(d for d, _ in found)
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
        by_label[label] = by_label.get(label, 0) + error
    joined = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, code, error, by_label[label]) for i, code, error, label in out), key=repr), \
        hashlib.sha256(joined.encode()).hexdigest()


def run(frame, **given):
    coded, books = codes.compress(frame, **given)
    rows = sorted(((row.vec_id, bytes(row.code).hex(), row.error, row.label_error) for row in coded.collect()), key=repr)
    return rows, checksum(books)


def test_matches_sql(spark):
    registered = LLM_REGISTRY["op13_vector_codes"]
    assert compare(registered.run(spark, SF).toArrow(), connect(SF).execute(registered.sql).to_arrow_table()) is None


def test_odd_rows_match_brute_force(spark):
    random = np.random.default_rng(2)
    rows = [(int(i), (random.integers(-9, 9, 32) / 64).tolist(), int(i) % 3 or None) for i in random.permutation(300)]
    rows += [(400, None, 1), (401, [None] + [0.5] * 31, 1), (402, [float("nan")] * 32, 1), (403, [float("inf")] + [0.0] * 31, 1),
             (None, [0.25] * 32, 2), rows[0], rows[0], (0, [-0.0] * 32, 7), (500, [0.1] * 8, 1), (501, [], 1)]
    frame = spark.createDataFrame([(*row, "x", "y", 1, 0.5) for row in rows], SCHEMA)
    assert run(frame) == brute(rows, 16, 64, 2)
    assert run(frame, parts=5, entries=9, rounds=3) == brute(rows, 5, 9, 3)


@pytest.mark.parametrize("count, length", [(5, 16), (1, 3), (70, 17)])
def test_few_rows_and_uneven_parts(spark, count, length):
    random = np.random.default_rng(count)
    rows = [(i, random.standard_normal(length).astype(np.float32).tolist(), 0) for i in range(count)]
    assert run(spark.createDataFrame([(*row, "x", "y", 1, 0.5) for row in rows], SCHEMA)) == brute(rows, 16, 64, 2)


def test_empty_table_and_very_large_components(spark):
    assert run(spark.createDataFrame([], SCHEMA))[0] == []
    frame = spark.createDataFrame([(1, [3e38] * 16, 1, "", "", 1, 1.0), (2, [-3e38] * 16, 1, "", "", 1, 1.0)], SCHEMA)
    assert [row[2] for row in run(frame)[0]] == [0, 0]


def test_walk_in_narrow_runs_gives_the_nearest_entry():
    random = np.random.default_rng(4)
    pieces, _ = codes.distinct_rows(random.integers(-3, 4, (500, 4)))
    book = random.integers(-3, 4, (64, 4))
    distance = ((pieces[:, None, :] - book[None]) ** 2).sum(axis=2)
    for width in (1, 2, 7, 4096):
        best, least = codes.nearest_entries(pieces, book, width)
        assert (best == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()


def test_decoded_vectors_are_the_entries(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    coded, books = codes.compress(frame, rounds=1)
    row = codes.decode(coded.orderBy("vec_id").limit(1), books).first()
    named = np.concatenate([book[entry] for book, entry in zip(books.books, bytes(row.code))])
    assert np.allclose(row.vector, (named + 0.5) / 256)
    whole = np.floor(np.float64(frame.orderBy("vec_id").first().embedding) * 256)
    assert ((whole - named) ** 2).sum() == row.error
