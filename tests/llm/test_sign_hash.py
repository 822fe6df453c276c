"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from lakeloom.llm import sign_hash

SCHEMA = "vec_id long, embedding array<double>, label int, mark string, cell long, head int, n_links int"


def brute(rows, threshold=0.9):
    """Entries are distinct (vec_id, vector); components follow links and equal ids."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    unit = [np.array(v) / np.abs(v).max() for _, v in good]
    unit = [v / np.linalg.norm(v) for v in unit]
    links, label = [0] * len(good), list(range(len(good)))
    for a in range(len(good)):
        for b in range(len(good)):
            near = a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold
            links[a] += bool(near)
            if near or good[a][0] == good[b][0]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    found = {entry: (links[k], good[label[k]][0]) for k, entry in enumerate(good)}
    out = []
    for i, v in rows:
        n, component = found.get((i, tuple(v) if v else None), (0, i))
        out.append((i, n, component, i is None or i == component))
    return sorted(out, key=repr)


def run(frame, **given):
    return sorted((tuple(row) for row in sign_hash.near_vectors(frame, **given).collect()), key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "m", 2, 3, 4) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def clustered():
    random = np.random.default_rng(9)
    rows = []
    for centre in random.standard_normal((12, 24)):
        for noise in (0.02, 0.2, 0.35, 0.45):
            rows += [(len(rows) + k, (centre + noise * random.standard_normal(24)).tolist()) for k in range(6)]
    return rows


def test_matches_all_pairs(spark, clustered):
    assert run(frame_of(spark, clustered)) == brute(clustered)


def test_large_cells_are_compared_in_blocks(spark, clustered):
    assert run(frame_of(spark, clustered), block=7) == brute(clustered)


def test_odd_rows(spark):
    one, two = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, one), (2, one), (2, one), (3, [x * 1e200 for x in one]), (4, [x * 1e-200 for x in one]), (5, one + [0.0]), (6, two),
            (7, None), (8, []), (9, [0.0] * 3), (10, [None, 1.0, 2.0]), (11, [float("nan")] * 3), (12, [float("inf"), 1.0, 1.0]),
            (None, one), (6, one), (13, [-x for x in one]), (14, [0.0, -0.0, 1.0]), (15, [0.0, 0.0, 1.0]), (-3, [3.0, -1.0, 0.6])]
    assert run(frame_of(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert run(frame_of(spark, [])) == []


def test_copies_fold_and_count(spark):
    rows = [(k, [1.0, 0.5]) for k in range(400)] + [(1000, [1.0, 0.51]), (1001, [-1.0, 0.5])]
    got = {row[0]: row for row in run(frame_of(spark, rows))}
    assert got[7] == (7, 400, 0, False) and got[1000] == (1000, 400, 0, False) and got[1001] == (1001, 0, 1001, True)


def test_plan_misses_no_more_at_any_size():
    for rows in (10, 10 ** 5, 10 ** 7, 10 ** 9):
        planes, tables = sign_hash.plan(rows, 0.9)
        same = (1 - np.arccos(0.9) / np.pi) ** planes
        assert (1 - same) ** tables <= sign_hash.MISS and rows / 2 ** planes <= sign_hash.CELL
