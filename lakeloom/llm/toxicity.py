"""Toxicity by multiple-instance learning: sentences score, documents are labelled.

A sentence's chance of being toxic is logistic in the features of its distinct
words; a document is toxic unless all its sentences are clean (noisy-or). Weights
are fitted to document labels on a bounded sample; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.llm.common import hash_spans, list_column, lower_ascii, require, slices, span_table, text_bytes

#: Hashed features; a power of two.
FEATURES = 1 << 18
#: A sentence ends at a terminator or after so many words.
SENTENCE_WORDS = 40
PREFIXES = (3, 4, 5, 6)
GRAM = 5
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x21, 0x3F, 0x0A]] = True


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


class Bag(NamedTuple):
    """Sentences as sets of words. ``text`` has the text of each sentence, ``start``
    and ``end`` its bytes; ``sentence`` and ``word`` are the distinct pairs; ``first``
    to ``last`` are the bytes of one occurrence of each distinct word."""
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray
    word: np.ndarray
    first: np.ndarray
    last: np.ndarray
    table: tuple[np.ndarray, np.ndarray]


def held_out(doc_id: Column) -> Column:
    """True for rows whose label is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bag_of(flat: np.ndarray, bounds: np.ndarray) -> Bag:
    inside = _LETTER[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[bounds] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    text = np.searchsorted(bounds, first, "right") - 1
    run = np.cumsum(_STOP[flat])[first] + text if len(first) else first
    new = np.ones(len(first), bool)
    new[1:] = run[1:] != run[:-1]
    place = np.arange(len(first)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(first) else first
    new |= place % SENTENCE_WORDS == 0
    sentence = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(first))
    table = span_table(flat)
    _, one, word = np.unique(hash_spans(flat, first, last, table), return_index=True, return_inverse=True)
    pairs = np.unique(sentence * max(1, len(one)) + word)
    return Bag(text[heads], first[heads], last[tails - 1] if len(heads) else heads,
               pairs // max(1, len(one)), pairs % max(1, len(one)), first[one], last[one], table)


def word_features(flat: np.ndarray, bag: Bag) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of word and hashed feature: the word, its prefixes, and the runs of
    ``GRAM`` bytes within it."""
    first, last, table = bag.first, bag.last, bag.table
    length = last - first
    words, codes = [np.arange(len(first))], [hash_spans(flat, first, last, table)]
    for size in PREFIXES:
        has = np.flatnonzero(length > size)
        words.append(has)
        codes.append(hash_spans(flat, first[has], first[has] + size, table) + np.uint64(size))
    count = np.maximum(length - GRAM + 1, 0)
    word = np.repeat(np.arange(len(first)), count)
    at = first[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    words.append(word)
    codes.append(hash_spans(flat, at, at + GRAM, table) + np.uint64(99))
    return np.concatenate(words), (np.concatenate(codes) % np.uint64(FEATURES)).astype(np.int64)


def _sentence_scores(flat: np.ndarray, bag: Bag, model: Model) -> np.ndarray:
    word, code = word_features(flat, bag)
    score = np.bincount(word, model.weights[code], minlength=len(bag.first))
    return model.bias + np.bincount(bag.sentence, score[bag.word], minlength=len(bag.text))


def fit(texts: list[str | None], labels: np.ndarray, steps: int = 80, rate: float = 0.1, shrink: float = 0.001,
        least: int = 3, sure: float = 2.5) -> Model:
    """Noisy-or likelihood by Adam, with proximal shrinkage in the first half of the
    steps; classes weigh alike.

    Features enter if at least ``least`` toxic texts hold them and their log odds
    of standing in a toxic text are ``sure`` standard errors above even. Without
    both classes nothing is known to be toxic, and all texts score 0.
    """
    labels = np.asarray(labels, bool)
    if labels.all() or not labels.any():
        return Model(np.zeros(FEATURES, np.float32), -12.0)
    flat, bounds = text_bytes(pa.array(texts, pa.string()))
    flat = lower_ascii(flat)
    bag = bag_of(flat, bounds)
    word, code = word_features(flat, bag)
    order = np.argsort(word, kind="stable")
    word, code = word[order], code[order]
    held = np.bincount(word, minlength=len(bag.first))
    begins = np.cumsum(held) - held
    seen = np.unique(bag.text[bag.sentence] * len(bag.first) + bag.word)
    text, one = seen // len(bag.first), seen % len(bag.first)
    toxic, clean = (_text_counts(text[labels[text] == kind], one[labels[text] == kind], held, begins, code)
                    for kind in (True, False))
    n_toxic, n_clean = labels.sum(), (~labels).sum()
    margin = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    good = (toxic >= least) & (margin >= sure * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)))
    word, code = word[good[code]], code[good[code]]
    used, code = np.unique(code, return_inverse=True)
    share = np.where(labels, 0.5 / n_toxic, 0.5 / n_clean)
    weights = np.append(np.zeros(len(used)), -5.0)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, 2 * steps + 1):
        if step == steps + 1:  # the features that are left are fitted without shrinkage
            keep = weights[:-1] != 0
            word, code = word[keep[code]], (np.cumsum(keep) - 1)[code[keep[code]]]
            used, stays = used[keep], np.append(keep, True)
            weights, mean, square = weights[stays], mean[stays], square[stays]
        per_word = np.bincount(word, weights[code], minlength=len(bag.first))
        z = weights[-1] + np.bincount(bag.sentence, per_word[bag.word], minlength=len(bag.text))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        calm = np.bincount(bag.text, np.logaddexp(0, z), minlength=len(texts))
        odds = np.exp(-calm) / np.maximum(-np.expm1(-calm), 1e-9)
        pull = p * np.where(labels, -odds, 1.0)[bag.text] * share[bag.text]
        by_word = np.bincount(bag.word, pull[bag.sentence], minlength=len(bag.first))
        gradient = np.append(np.bincount(code, by_word[word], minlength=len(used)), pull.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        pace = rate / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-5)
        weights -= pace * mean / (1 - 0.9 ** step)
        if step <= steps:
            weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - pace[:-1] * shrink, 0)
    out = np.zeros(FEATURES, np.float32)
    out[used] = weights[:-1]
    return Model(out, float(weights[-1]))


def _text_counts(text: np.ndarray, word: np.ndarray, held: np.ndarray, begins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """In how many texts each feature stands; texts are taken some at a time."""
    counts = np.zeros(FEATURES, np.int64)
    cuts = np.flatnonzero(np.diff(text)) + 1
    for low, high in zip([0, *cuts[199::200].tolist()], [*cuts[199::200].tolist(), len(text)]):
        size = held[word[low:high]]
        at = np.repeat(begins[word[low:high]] - np.cumsum(size) + size, size) + np.arange(size.sum())
        pairs = np.unique(np.repeat(text[low:high], size) * FEATURES + code[at])
        counts += np.bincount(pairs % FEATURES, minlength=FEATURES)
    return counts


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 10_000) -> Model:
    """Fit on about ``per_class`` labelled documents of each class, chosen by a hash
    of doc_id among those not held out and of at most ``longest`` characters. These
    two parameters bound the one task that fits; the driver gets the model alone.
    Labels of repeated rows must agree; a document called toxic once counts as toxic."""
    require(labels, "doc_id", "toxic")
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_class / max(sizes.get(1, 0), 1)).otherwise(per_class / max(sizes.get(0, 0), 1))
    chosen = known.where(chance < share).limit(4 * per_class)
    rows = docs.where(F.length("text") <= longest).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").limit(
        8 * per_class)
    return _fitted(rows)


def _fitted(rows: DataFrame) -> Model:
    """``fit`` to doc_id, text and toxic, in one task in order of doc_id. What fitting
    holds, many times the texts, is not the driver's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held := [batch for batch in batches if batch.num_rows]:
            ordered = pa.Table.from_batches(held).sort_by("doc_id")
            model = fit(ordered.column("text").to_pylist(), np.asarray(ordered.column("toxic")) == 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    found = rows.select("doc_id", "text", "toxic").coalesce(1).mapInArrow(run, "weights binary, bias double").toArrow()
    if not found.num_rows:
        return fit([], np.zeros(0, bool))
    return Model(np.frombuffer(found.column("weights")[0].as_py(), np.float32), found.column("bias")[0].as_py())


def _score_part(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Score of each text; start, end (code points), score and text of its sentences."""
    flat, bounds = text_bytes(texts)
    letters = np.zeros(len(flat) + 1, np.int64)
    np.cumsum((flat & 0xC0) != 0x80, out=letters[1:])
    flat = lower_ascii(flat)
    bag = bag_of(flat, bounds)
    z = _sentence_scores(flat, bag, model)
    # What even a sentence without any known feature would add is left out, so that
    # length alone makes no text toxic.
    weight = np.maximum(np.logaddexp(0, z) - np.logaddexp(0, model.bias), 0)
    score = -np.expm1(-np.bincount(bag.text, weight, minlength=len(texts)))
    shift = letters[bounds[bag.text]]
    return score, letters[bag.start] - shift, letters[bag.end] - shift, -np.expm1(-weight), bag.text


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and ``offending``: the sentences (start, end in code points, and
    chance) with a chance of one half or more, for every row of ``docs``.

    A null or empty text, or one without letters, scores 0. Rows that repeat are
    scored alike. Columns other than doc_id and text are ignored.
    """
    require(docs, "doc_id", "text")
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(model))
    sentence = "array<struct<start: int, end: int, chance: double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score, start, end, chance, text = _score_part(part.column(1), Model(*shipped.value))
                bad = chance >= 0.5
                spans = pa.StructArray.from_arrays(
                    [pa.array(start[bad].astype(np.int32)), pa.array(end[bad].astype(np.int32)), pa.array(chance[bad])],
                    ["start", "end", "chance"])
                found = np.bincount(text[bad], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), list_column(spans, found, spans.type)],
                    ["doc_id", "score", "offending"])

    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, score double, offending {sentence}")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    require(docs, "text")
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = _score_part(part.column(part.schema.get_field_index("text")), Model(*shipped.value))[0]
                yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
