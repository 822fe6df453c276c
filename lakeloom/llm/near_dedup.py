"""Near-duplicate texts by SuperMinHash signatures, verified on whole shingle sets.

Steps: one pass over the texts makes a signature for each; equal word sequences
fold into classes; bands of the signatures fill buckets; each bucket's members are
compared with the bucket's first member, and links fold into components. Members
of one bucket that are still apart are then compared with each other, so that a
link is not lost because both ends are unlike the first member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import (
    binary_column, find_words, groups, hash_spans, list_column, lower_ascii, mix, powers, require, slices, stored, text_bytes,
)
from lakeloom.session import conf_scope

WORDS = 5
SLOTS = 128
ROWS = 4
#: Members of a bucket compared at once, and shared shingles held at once while doing so.
BLOCK = 1024
COLUMNS = 2048
_UNSET = np.uint32(0xFFFFFFFF)
_SIGNED = "doc_id long, key_a long, key_b long, n_shingles long, bands array<long>, sketch binary"


def shingles(flat: np.ndarray, bounds: np.ndarray, words: int = WORDS):
    """Distinct shingles as (text, hash) sorted by both, and per text the word
    count and a 128-bit hash of its word sequence."""
    flat = lower_ascii(flat)
    count = len(bounds) - 1
    start, end, doc = find_words(flat, bounds)
    word = hash_spans(flat, start, end)
    n_words = np.bincount(doc, minlength=count)
    first = np.zeros(count + 1, np.int64)
    np.cumsum(n_words, out=first[1:])
    place = np.arange(len(word)) - first[doc]
    keys = []
    for salt in (1, 2):
        sums = np.zeros(len(word) + 1, np.uint64)
        scale = powers(int(n_words.max(initial=0)), np.uint64(0xD6E8FEB86659FD93 + 2 * salt))
        np.cumsum(mix(word + np.uint64(salt)) * scale[place], out=sums[1:])
        keys.append(mix(sums[first[1:]] - sums[first[:-1]] + n_words.astype(np.uint64)))
    width = np.minimum(n_words, words)
    is_start = place + width[doc] <= n_words[doc]
    at = np.flatnonzero(is_start)
    value = np.zeros(len(at), np.uint64)
    for step in range(words):
        inside = step < width[doc[at]]
        value[inside] = mix(value[inside] * np.uint64(0x9E3779B97F4A7C15) + word[at[inside] + step] + np.uint64(step))
    order = np.lexsort((value, doc[at]))
    doc, value = doc[at][order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new], n_words, keys


def super_minhash(doc: np.ndarray, value: np.ndarray, count: int, slots: int = SLOTS) -> np.ndarray:
    """One signature a text: each element walks its own random permutation of the
    slots, and step j offers j plus a fraction to the slot it meets. A later step
    offers more than any earlier one, so a text is done once its slots are filled."""
    signature = np.full((count, slots), _UNSET, np.uint32)
    walk = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(value), 1))
    for step in range(slots):
        if not len(value):
            break
        random = mix(value + np.uint64((step + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        fraction = (random & np.uint64(0x1FFFFFF)).astype(np.uint32)
        pick = step + ((random >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(value))
        met = walk[rows, pick]
        walk[rows, pick] = walk[:, step]
        np.minimum.at(signature.reshape(-1), doc * slots + met, np.uint32(step << 25) | fraction)
        open_texts = (signature == _UNSET).any(axis=1)
        left = open_texts[doc]
        if not left.all():
            doc, value, walk = doc[left], value[left], walk[left]
    return signature


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            flat, bounds = text_bytes(part.column(1))
            doc, value, _, keys = shingles(flat, bounds)
            count = part.num_rows
            signature = super_minhash(doc, value, count)
            bands = np.zeros((count, SLOTS // ROWS), np.uint64)
            for row in range(ROWS):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + signature[:, row::ROWS])
            bands = mix(bands + np.arange(SLOTS // ROWS, dtype=np.uint64))
            sketch = mix(signature.astype(np.uint64)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                part.column(0).cast(pa.int64()), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                pa.array(np.bincount(doc, minlength=count).astype(np.int64)),
                list_column(bands.view(np.int64).reshape(-1), np.full(count, SLOTS // ROWS), pa.int64()),
                binary_column(sketch.reshape(-1), np.full(count, SLOTS)),
            ], ["doc_id", "key_a", "key_b", "n_shingles", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            flat, bounds = text_bytes(part.column(1))
            doc, value, _, _ = shingles(flat, bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), binary_column(value, np.bincount(doc, minlength=part.num_rows))], ["doc_id", "items"])


def _similar(threshold: int):
    """Keep pairs whose sets reach the threshold, in hundredths of the union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                one = np.frombuffer(left[row].as_buffer(), np.uint64)
                two = np.frombuffer(right[row].as_buffer(), np.uint64)
                # Within sorted sets a shared item is one that follows itself.
                both = np.sort(np.concatenate([one, two]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[row] = 100 * common >= threshold * (len(one) + len(two) - common)
            yield pa.RecordBatch.from_arrays([column.filter(pa.array(keep)) for column in batch.columns[:2]], ["a", "b"])
    return run


def _alike(threshold: int):
    """Keep pairs whose sketches agree in as many slots as the threshold would by
    chance give at six standard deviations below its mean."""
    share = threshold / 100
    least = SLOTS * share - 6 * (SLOTS * share * (1 - share)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in (2, 3)]
            keep = pa.array((sides[0] == sides[1]).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([column.filter(keep) for column in batch.columns[:2]], ["a", "b"])
    return run


def _paired(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    one = side.select(F.col("doc_id").alias("a"), F.col(column).alias("one"))
    two = side.select(F.col("doc_id").alias("b"), F.col(column).alias("two"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two")


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    close = _paired(pairs, sketches, "sketch").mapInArrow(_alike(threshold), "a long, b long")
    close = stored(close, "near-close")
    return stored(_paired(close, sets, "items").mapInArrow(_similar(threshold), "a long, b long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """The smallest id reachable from each linked id (columns id, component), by
    min-label rounds with pointer jumping. Each round is one stored table."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
                    .select("id", F.least("id", "low").alias("component"), F.lit(True).alias("moved")), "near-labels")
    while labels.where("moved").limit(1).count():
        seen = labels.select("id", "component")
        near = both.join(seen.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("component").alias("near"))
        stepped = stored(
            seen.join(near, "id", "left").select(
                "id", F.col("component").alias("old"), F.least("component", "near").alias("component")), "near-step")
        jump = stepped.select(F.col("id").alias("component"), F.col("component").alias("next"))
        labels = stored(stepped.join(jump, "component", "left").select(
            "id", F.least("component", "next").alias("component"),
            (F.least("component", "next") < F.col("old")).alias("moved")), "near-labels")
    return labels.select("id", "component")


def near_duplicates(docs: DataFrame, threshold: int = 75, rounds: int = 1) -> DataFrame:
    """Components of texts whose five-word shingle sets share ``threshold`` hundredths.

    Returns one row a row of ``docs``: doc_id, n_shingles, component_id, kept.
    Words are runs without ASCII white space, A-Z lowered. A null or empty text,
    or one of white space alone, has no shingles, links with nothing and is kept.
    Rows that repeat a doc_id are one document: their texts' links are joined and
    they share a verdict. A null doc_id links with nothing, has a null
    component_id and is kept. Columns other than doc_id and text are ignored.
    """
    require(docs, "doc_id", "text")
    with conf_scope(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}):
        return _near_duplicates(docs, threshold, rounds)


def _near_duplicates(docs: DataFrame, threshold: int, rounds: int) -> DataFrame:
    signed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign, _SIGNED),
                    "near-signed")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    classes = stored(usable.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("size")),
                     "near-classes")
    # Only texts with copies need the join; a text alone is its own class.
    copied = classes.where("size > 1").select("key_a", "key_b", "class_id")
    members = stored(usable.select("doc_id", "key_a", "key_b").join(copied, ["key_a", "key_b"])
                     .where("doc_id <> class_id").select("doc_id", "class_id"), "near-members")
    first = classes.select(F.col("class_id").alias("doc_id"), "key_a", "key_b")
    heads = stored(usable.join(first, ["doc_id", "key_a", "key_b"], "left_semi")
                   .dropDuplicates(["doc_id", "key_a", "key_b"]), "near-heads")

    cells = heads.select("doc_id", F.explode("bands").alias("cell"))
    shared = stored(cells.groupBy("cell").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                    .where("low < high").select("cell", "low"), "near-shared")
    in_cells = stored(cells.join(shared, "cell"), "near-cells")
    involved = in_cells.select("doc_id").distinct()
    sketches = heads.select("doc_id", "sketch")
    sets = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
            involved, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, items binary"),
        "near-sets")

    links = members.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    pairs = in_cells.where("doc_id > low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = links.union(_verified(pairs, sketches, sets, threshold))
    found = components(links)
    apart = stored(_apart(in_cells, found), "near-apart")
    for turn in range(rounds):  # against one other member of each bucket
        chance = F.xxhash64("doc_id", F.lit(turn))
        guides = stored(apart.groupBy("cell").agg(
            F.min_by("doc_id", chance).alias("guide"), F.min_by("component", chance).alias("held")), "near-guides")
        pairs = apart.join(guides, "cell").where("component <> held").select(
            F.least("guide", "doc_id").alias("a"), F.greatest("guide", "doc_id").alias("b")).distinct()
        new = _verified(pairs, sketches, sets, threshold)
        if new.limit(1).count():
            links = links.union(new)
            found = components(links)
            apart = stored(_apart(apart, found), "near-apart")
    new = stored(_within(apart, sets, threshold), "near-links")
    if new.limit(1).count():
        found = components(links.union(new.distinct()))
    found = found.withColumnRenamed("id", "doc_id")
    return signed.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _within(apart: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between members of one bucket in different components. A bucket is
    dealt into blocks; each pair of blocks is compared in one task, which returns
    links only. Of buckets with equal members one is enough."""
    mark = F.xxhash64("doc_id")
    kinds = apart.groupBy("cell").agg(
        F.count("*").alias("size"), F.sum(F.col("doc_id").cast("decimal(38,0)")).alias("total"),
        F.bit_xor(mark).alias("marks"))
    one_of = stored(kinds.groupBy("size", "total", "marks").agg(F.min("cell").alias("cell")).select("cell", "size"),
                    "near-kinds")
    rows = apart.join(one_of, "cell").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(mark, F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "component")
    rows = rows.join(sets, "doc_id").select("cell", "i", "j", "block", "doc_id", "component", "items")
    return rows.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(
        _compare(threshold), "a long, b long")


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            block, doc, component = (group.column(c).to_numpy() for c in (3, 4, 5))
            items = [np.frombuffer(value.as_buffer(), np.uint64) for value in group.column(6)]
            size = np.array([len(one) for one in items], np.float64)
            _, place, uses = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(items)), size.astype(np.int64))
            shared = np.flatnonzero(uses > 1)
            column = np.full(len(uses), -1)
            column[shared] = np.arange(len(shared))
            row, place = row[column[place] >= 0], column[place[column[place] >= 0]]
            common = np.zeros((len(items), len(items)), np.float64)
            for low in range(0, len(shared), COLUMNS):
                here = (place >= low) & (place < low + COLUMNS)
                has = np.zeros((len(items), min(COLUMNS, len(shared) - low)), np.float32)
                has[row[here], place[here] - low] = 1
                common += has @ has.T
            link = 100 * common >= threshold * (size[:, None] + size[None, :] - common)
            link &= (component[:, None] != component[None, :]) & (doc[:, None] < doc[None, :])
            if group.column(1)[0] != group.column(2)[0]:
                link &= block[:, None] != block[None, :]
            one, two = np.nonzero(link)
            yield pa.RecordBatch.from_arrays([pa.array(doc[one]), pa.array(doc[two])], ["a", "b"])
    return run


def _apart(in_cells: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the cells that still hold more than one component."""
    placed = in_cells.select("cell", "doc_id").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "cell", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = placed.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low < high").select("cell")
    return placed.join(mixed, "cell", "left_semi")
