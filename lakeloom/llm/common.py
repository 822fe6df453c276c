"""Helpers shared by the operators: stored steps, Arrow slices, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.session import scratch_path

#: Text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a step below ``spark.checkpoint.dir`` and read it back: what follows
    does not recompute it, and it outlives the executors that made it."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def require(frame: DataFrame, *columns: str) -> None:
    missing = [name for name in columns if name not in frame.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``most`` bytes of text (one row at least)."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
    start = 0
    while start < batch.num_rows:
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:start + 65536]), most, "right")))
        yield batch.slice(start, min(stop, batch.num_rows) - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes end to end, and the offsets of each; a null text is empty."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def find_words(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word: a run without space or 0x09 to 0x0D."""
    inside = ~_SPACE[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


def lower_ascii(flat: np.ndarray) -> np.ndarray:
    return _LOWER[flat]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(count: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_table(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``hash_spans`` needs of some bytes; compute it once for several calls."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.multiply(_LETTERS[flat], powers(len(flat)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums, powers(len(flat) + 1, _INVERSE)


def hash_spans(flat: np.ndarray, start: np.ndarray, end: np.ndarray,
               table: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    sums, back = table or span_table(flat)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(
        pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values, kind))


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Byte strings cut from one array; counts are in items of the array."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first ``keys`` integer columns, from
    batches sorted by them. One run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(column) for column in batch.columns[:keys]], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = tuple(values[start].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)
