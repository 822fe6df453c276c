"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The text is cut where a run of spaces begins, which no piece spans; equal cuts of a
slice are encoded once. All starts of all cuts walk the trie together, and paths
are settled from left to right for all cuts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeloom.llm.common import hash_spans, list_column, require, slices, text_bytes

#: How much worse than the worst piece an unknown character is, as the public format has it.
UNKNOWN_PENALTY = 10.0
SPACE = 0x20
#: Flattens the head of the law by which ranks become probabilities.
RANK_SHIFT = 2.7
NO_MERGE = -1e8


class Trie(NamedTuple):
    """``check[base[s] + byte]`` is s where s has that child; ``piece`` is the id that
    ends in a node, or -1."""
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray


class Vocabulary(NamedTuple):
    trie: Trie
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int
    unknown_score: float
    spelled: np.ndarray
    spelled_at: np.ndarray
    whole: bool


def build_trie(words: dict[bytes, int]) -> Trie:
    """A double array, level by level. An only child takes the first free place, so it
    fills gaps; the search for more moves on from places where it took long."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in words.items():
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][byte]
        ends[node] = number
    size = 2 * len(children) + 1024
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    place, low, dense, queue = {0: 0}, 256, 256, [0]
    for node in queue:  # grows while it is walked
        if not children[node]:
            continue
        keys = list(children[node])
        at = (low if len(keys) == 1 else dense) - min(keys)
        tries = 0
        while any(used[at + key] for key in keys):
            at += 1
            tries += 1
        if len(keys) > 1 and tries > 64:
            dense = at + min(keys)
        if at + 512 > size:
            extra = size
            base, check, piece = (np.concatenate([old, np.full(extra, fill, np.int32)])
                                  for old, fill in ((base, 0), (check, -1), (piece, -1)))
            used.extend(bytes(extra))
            size += extra
        base[place[node]] = at
        for key, child in children[node].items():
            used[at + key] = 1
            check[at + key] = place[node]
            place[child] = at + key
            piece[at + key] = ends[child]
            queue.append(child)
        while used[low]:
            low += 1
    return Trie(base, check, piece)


def load(path: str) -> Vocabulary:
    """Pieces of a public model file with log scores, read on the driver. The scores
    of a file whose scores are ranks become log probabilities by ``from_ranks``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        (model.id_to_piece(i), model.get_score(i),
         "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else
         "control" if model.is_control(i) or model.is_unused(i) else "normal")
        for i in range(model.get_piece_size())]
    return vocabulary(from_ranks(pieces) if are_ranks(pieces) else pieces)


def are_ranks(pieces: list[tuple[str, float, str]]) -> bool:
    """Scores of merges fall by one from id to id; log scores do not. Pieces that no
    merge makes stand far below."""
    sums = {number + score for number, (_, score, kind) in enumerate(pieces) if kind == "normal" and score > NO_MERGE}
    return len(sums) == 1


def from_ranks(pieces: list[tuple[str, float, str]], shift: float = RANK_SHIFT) -> list[tuple[str, float, str]]:
    """Log probabilities by the law of Zipf and Mandelbrot: a piece's probability falls
    as one over its rank, in order of ids, plus ``shift``. Nothing is learned from a
    corpus."""
    normal = [number for number, piece in enumerate(pieces) if piece[2] == "normal"]
    weight = 1 / (np.arange(1, len(normal) + 1) + shift)
    logs = dict(zip(normal, (np.log(weight) - np.log(weight.sum())).tolist()))
    return [(piece, logs.get(number, score), kind) for number, (piece, score, kind) in enumerate(pieces)]


def vocabulary(pieces: list[tuple[str, float, str]]) -> Vocabulary:
    """(piece, log score, kind) in order of ids; kinds: normal, byte, unknown, control."""
    words, spelled, byte_ids, unknown = {}, [], np.full(256, -1, np.int64), 0
    scores = np.zeros(len(pieces) + 1)
    for number, (piece, score, kind) in enumerate(pieces):
        scores[number] = score
        text = piece.replace("\u2581", " ").encode()
        if kind == "normal":
            words.setdefault(text, number)
        elif kind == "byte":
            byte_ids[int(piece[3:5], 16)] = number
            text = bytes([int(piece[3:5], 16)])
        else:
            unknown = number if kind == "unknown" else unknown
            text = " \u2047 ".encode() if kind == "unknown" else b""
        spelled.append(text)
    lengths = np.array([len(text) for text in spelled])
    return Vocabulary(
        build_trie(words), scores, byte_ids, unknown,
        min((scores[number] for number in words.values()), default=0.0) - UNKNOWN_PENALTY,
        np.frombuffer(b"".join(spelled), np.uint8), np.append(0, np.cumsum(lengths)),
        any(b" " in word.lstrip(b" ") for word in words))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` items each, end to end."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def _matches(flat: np.ndarray, bounds: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and id of every piece that stands in a cut."""
    stop = np.repeat(bounds[1:], np.diff(bounds))
    start = np.flatnonzero((flat & 0xC0) != 0x80)
    state = np.zeros(len(start), np.int32)
    at, found = start.copy(), []
    while len(start):
        inside = at < stop[start]
        start, at, state = start[inside], at[inside], state[inside]
        step = trie.base[state] + flat[at]
        good = trie.check[step] == state
        start, at, state = start[good], at[good] + 1, step[good]
        ends = np.flatnonzero(trie.piece[state] >= 0)
        found.append((start[ends], at[ends], trie.piece[state[ends]]))
    return tuple(np.concatenate(parts).astype(np.int64) for parts in zip(*found)) if found else (
        np.zeros(0, np.int64),) * 3


def viterbi(flat: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best path of each cut, end to end, and how many each has.

    Of equal paths the one whose last piece begins earliest wins, at each place. A
    character that is no piece is unknown: it is spelled in bytes where the
    vocabulary has byte pieces.
    """
    start, end, piece = _matches(flat, bounds, vocab.trie)
    letter = np.flatnonzero((flat & 0xC0) != 0x80)
    after = np.append(letter[1:], len(flat))
    if len(letter):
        after = np.minimum(after, bounds[np.searchsorted(bounds, letter, "right")])
    whole = np.zeros(len(flat) + 1, np.int64)
    whole[letter] = after
    single = np.zeros(len(flat) + 1, bool)
    single[start[whole[start] == end]] = True
    lone = letter[~single[letter]]
    start = np.concatenate([start, lone])
    end = np.concatenate([end, whole[lone]])
    score = np.concatenate([vocab.scores[piece], np.full(len(lone), vocab.unknown_score)])
    piece = np.concatenate([piece, np.full(len(lone), -1, np.int64)])
    origin = bounds[np.searchsorted(bounds, start, "right") - 1] if len(start) else start
    place = start - origin
    order = np.argsort(place, kind="stable")
    start, end, score, piece, place = start[order], end[order], score[order], piece[order], place[order]
    # Positions at a cut's end and at the next one's start differ, hence the shift.
    shift = np.searchsorted(bounds, start, "right") - 1
    best = np.full(len(flat) + len(bounds), -np.inf)
    back = np.full(len(flat) + len(bounds), -1, np.int64)
    best[bounds[:-1] + np.arange(len(bounds) - 1)] = 0
    source, target = start + shift, end + shift
    cuts = np.append(0, np.flatnonzero(np.diff(place)) + 1) if len(place) else []
    for low, high in zip(cuts, np.append(cuts[1:], len(place)) if len(place) else []):
        reach = best[source[low:high]] + score[low:high]
        better = np.flatnonzero(reach > best[target[low:high]])
        best[target[low + better]] = reach[better]
        back[target[low + better]] = low + better
    cut = np.flatnonzero(np.diff(bounds) > 0)
    at = bounds[cut + 1] + cut
    owners, steps = [], []
    while len(cut):
        step = back[at]
        owners.append(cut)
        steps.append(step)
        at = source[step]
        more = at > bounds[cut] + cut
        cut, at = cut[more], at[more]
    if not owners:
        return np.zeros(0, np.int32), np.zeros(len(bounds) - 1, np.int64)
    owner, step = np.concatenate(owners[::-1]), np.concatenate(steps[::-1])
    order = np.argsort(owner, kind="stable")
    owner, step = owner[order], step[order]
    unknown = piece[step] < 0
    spell = unknown & (vocab.byte_ids[0] >= 0)
    count = np.where(spell, end[step] - start[step], 1)
    ids = np.repeat(np.where(unknown, vocab.unknown_id, piece[step]), count)
    ids[np.repeat(spell, count)] = vocab.byte_ids[flat[_ranges(start[step[spell]], count[spell])]]
    return ids.astype(np.int32), np.bincount(owner, count, minlength=len(bounds) - 1).astype(np.int64)


def _marked(texts: pa.Array, prefix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts with U+2581 as a space, and a space before each that is not empty."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.compute.replace_substring(texts, "\u2581", " ")
    if prefix:
        texts = pa.compute.if_else(pa.compute.equal(texts, ""), "", pa.compute.binary_join_element_wise(
            pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    return text_bytes(texts)


def encode_texts(texts: pa.Array, vocab: Vocabulary, prefix: bool = True) -> tuple[np.ndarray, np.ndarray]:
    flat, bounds = _marked(texts, prefix)
    if not len(flat):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    opens = np.zeros(len(flat) + 1, bool)
    opens[bounds] = True
    if not vocab.whole:
        gap = flat == SPACE
        opens[1:-1] |= gap[1:] & ~gap[:-1]
    cut = np.flatnonzero(opens[:-1])
    stop = np.append(cut[1:], len(flat))
    _, one, kind = np.unique(hash_spans(flat, cut, stop), return_index=True, return_inverse=True)
    size = stop[one] - cut[one]
    ids, count = viterbi(flat[_ranges(cut[one], size)], np.append(0, np.cumsum(size)), vocab)
    first = np.cumsum(count) - count
    text = np.searchsorted(bounds, cut, "right") - 1
    return (ids[_ranges(first[kind], count[kind])],
            np.bincount(text, count[kind], minlength=len(texts)).astype(np.int64))


def decode_ids(ids: np.ndarray, counts: np.ndarray, vocab: Vocabulary, prefix: bool = True) -> list[bytes]:
    """The bytes each run of ids spells, without the space put before the text."""
    size = np.diff(vocab.spelled_at)[ids]
    flat = vocab.spelled[_ranges(vocab.spelled_at[ids], size)].tobytes()
    ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
    out = [flat[low:high] for low, high in zip(ends, ends[1:])]
    return [text[1:] if prefix and text[:1] == b" " else text for text in out]


def _ship(frame: DataFrame, vocab: Vocabulary):
    return frame.sparkSession.sparkContext.broadcast((tuple(vocab.trie), *vocab[1:]))


def _unpack(value: tuple) -> Vocabulary:
    return Vocabulary(Trie(*value[0]), *value[1:])


def encode(docs: DataFrame, vocab: Vocabulary, prefix: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (null and empty texts: none), ``n_byte_ids`` and ``exact``.

    ``exact`` says that decoding gives the text back, which U+2581 in a text
    prevents. Repeated rows are encoded each, other columns pass through; columns of
    the three names are replaced.
    """
    require(docs, "text")
    names = [name for name in docs.columns if name not in ("ids", "n_byte_ids", "exact")]
    plain = docs.select(*[F.col(f"`{name}`") for name in names])
    shipped = _ship(docs, vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _unpack(shipped.value)
        is_byte = np.zeros(len(vocab.scores), np.int64)
        is_byte[vocab.byte_ids[vocab.byte_ids >= 0]] = 1
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(part.schema.get_field_index("text"))
                ids, counts = encode_texts(texts, vocab, prefix)
                spelled = np.append(0, np.cumsum(is_byte[ids]))[np.append(0, np.cumsum(counts))]
                flat, bounds = text_bytes(texts)
                flat, bounds = flat.tobytes(), bounds.tolist()
                exact = [flat[low:high] == back for low, high, back in zip(
                    bounds, bounds[1:], decode_ids(ids, counts, vocab, prefix))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, list_column(ids, counts, pa.int32()), pa.array(np.diff(spelled)), pa.array(exact)],
                    [*part.schema.names, "ids", "n_byte_ids", "exact"])

    added = StructType.fromDDL("ids array<int>, n_byte_ids long, exact boolean")
    return plain.mapInArrow(run, StructType([*plain.schema.fields, *added.fields]))


def decode(rows: DataFrame, vocab: Vocabulary, prefix: bool = True) -> DataFrame:
    """``rows`` with ``decoded``: what ``ids`` spell, bytes that are no UTF-8 replaced;
    null ids give a null. Ids outside the vocabulary fail the job."""
    require(rows, "ids")
    plain = rows.select(*[F.col(f"`{name}`") for name in rows.columns if name != "decoded"])
    shipped = _ship(rows, vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _unpack(shipped.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
            ids = np.asarray(column.flatten(), np.int64)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(vocab.spelled_at) - 1):
                raise ValueError("an id is outside the vocabulary")
            texts = [text.decode(errors="replace") if known else None for text, known in zip(
                decode_ids(ids, counts, vocab, prefix), column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("decoded", StringType())]))
