"""Near duplicates against brute force over whole shingle sets."""

import numpy as np

from lakeloom.llm import near_dedup
from lakeloom.llm.common import text_bytes

import pyarrow as pa


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {i: shingle_set(text) for i, text in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_query_matches_brute_force(documents):
    got = {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in near_dedup.near_duplicates(documents).collect()}
    assert got == brute([(row.doc_id, row.text) for row in documents.collect()])


def test_links_off_the_first_member(spark):
    """Chains and groups whose members are unlike the smallest id."""
    random = np.random.default_rng(5)
    base = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(160):
        words = list(base)
        for at in random.choice(60, size=random.integers(0, 4), replace=False):
            words[at] = f"n{k}-{at}"
        rows.append((k, " ".join(words)))
    got = {row.doc_id: (row.n_shingles, row.component_id, row.kept)
           for row in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_odd_rows(odd_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {row.doc_id: row for row in rows if row.doc_id is not None}
    assert {i for i in by_id if not by_id[i].kept} == {1, 2, 7}
    assert by_id[2].component_id == 0 and by_id[7].component_id == 6
    assert all(by_id[i].n_shingles == 0 and by_id[i].kept for i in (3, 4, 5))
    assert by_id[9].n_shingles == 39_996
    assert all(row.component_id is None and row.kept for row in rows if row.doc_id is None)


def test_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_signature_is_that_of_the_sequential_algorithm():
    """Slot by slot: the least step plus fraction any element offers."""
    flat, bounds = text_bytes(pa.array(["a b c d e f g h i j", "k l m n o"]))
    doc, value, _, _ = near_dedup.shingles(flat, bounds)
    got = near_dedup.super_minhash(doc, value, 2, slots=16)
    for text in (0, 1):
        want = [0xFFFFFFFF] * 16
        for element in value[doc == text]:
            walk = list(range(16))
            for step in range(16):
                random = int(near_dedup.mix(np.array([element]) + np.uint64((step + 1) * 0xA0761D6478BD642F & (2 ** 64 - 1)))[0])
                pick = step + ((random >> 32) * (16 - step) >> 32)
                walk[step], walk[pick] = walk[pick], walk[step]
                want[walk[step]] = min(want[walk[step]], step << 25 | random & 0x1FFFFFF)
        assert got[text].tolist() == want


def test_signatures_estimate_similarity():
    one = " ".join(f"a{k}" for k in range(300))
    two = " ".join([f"a{k}" for k in range(240)] + [f"b{k}" for k in range(60)])
    flat, bounds = text_bytes(pa.array([one, two]))
    doc, value, _, _ = near_dedup.shingles(flat, bounds)
    first, second = (set(value[doc == k].tolist()) for k in (0, 1))
    signature = near_dedup.super_minhash(doc, value, 2)
    assert abs((signature[0] == signature[1]).mean() - len(first & second) / len(first | second)) < 0.12
