"""Counts of whole texts, by whole-array work on slices of a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import find_words, hash_spans, mix, require, slices, span_table, text_bytes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(letter) for letter in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def _repeats(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its text holds its value before it, and whether at all
    more than once."""
    order = np.lexsort((np.arange(len(value)), value, doc))
    same = np.zeros(len(value), bool)
    same[1:] = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
    later, shared = np.zeros(len(value), bool), np.zeros(len(value), bool)
    later[order] = same
    both = same.copy()
    both[:-1] |= same[1:]
    shared[order] = both
    return later, shared


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts per text. Words are runs without ASCII white space; lines are parts
    between newlines that hold a word; a repeated word stands in a window of three
    words found twice or more in its text."""
    flat, bounds = text_bytes(texts)
    count = len(bounds) - 1
    start, end, doc = find_words(flat, bounds)

    def sums(mask: np.ndarray) -> np.ndarray:
        running = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(mask, out=running[1:])
        return running

    points = sums((flat & 0xC0) != 0x80)
    table = span_table(flat)
    word = hash_spans(flat, start, end, table)
    n_words = np.bincount(doc, minlength=count)

    whole = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) > 2 else np.zeros(0, np.int64)
    window = mix(mix(mix(word[whole]) + word[whole + 1]) + word[whole + 2])
    _, shared = _repeats(doc[whole], window)
    repeated = np.zeros(len(word), bool)
    for step in range(3):
        repeated[whole[shared] + step] = True

    cut = np.flatnonzero(flat == 0x0A)
    line_start = np.unique(np.concatenate([bounds[:-1], cut + 1]))
    line_start = line_start[line_start < len(flat)]
    line_end = np.append(line_start[1:], len(flat))
    line_end = line_end - (flat[line_end - 1] == 0x0A) if len(line_end) else line_end
    before = np.searchsorted(start, line_start)
    has = np.searchsorted(start, line_end) > before
    line_start, line_end = line_start[has], line_end[has]
    line_doc = np.searchsorted(bounds, line_start, "right") - 1
    later, _ = _repeats(line_doc, hash_spans(flat, line_start, line_end, table))
    again, _ = _repeats(doc, word)

    symbols, upper = sums(_SYMBOL[flat]), sums(_UPPER[flat])
    return {
        "n_words": n_words,
        "word_chars": np.bincount(doc, points[end] - points[start], minlength=count).astype(np.int64),
        "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]],
        "n_dup_lines": np.bincount(line_doc[later], minlength=count),
        "n_repeat_words": np.bincount(doc[repeated], minlength=count),
        "n_lines": np.bincount(line_doc, minlength=count),
        "n_upper": upper[bounds[1:]] - upper[bounds[:-1]],
        "n_distinct": np.bincount(doc[~again], minlength=count),
    }


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            counts = count_texts(part.column(part.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *(pa.array(counts[name].astype(np.int64)) for name in COUNTS)],
                [*part.schema.names[:-1], *COUNTS])


def text_stats(docs: DataFrame, *keys: str) -> DataFrame:
    """The key columns and the counts of each row's whole text (null: no words)."""
    require(docs, "text", *keys)
    plain = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"`{name}` {plain.schema[name].dataType.simpleString()}" for name in keys)
    return plain.mapInArrow(_run, f"{kinds}, " + ", ".join(f"{name} long" for name in COUNTS))
