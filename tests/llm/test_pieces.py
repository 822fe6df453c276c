"""Encoding against plain Viterbi and the public library's best path; round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import pieces
from lakeloom.llm.queries_tokens import MODEL

BYTES = [(f"<0x{byte:02X}>", -1e9, "byte") for byte in range(256)]
SMALL = [("<unk>", 0.0, "unknown"), *BYTES, *[(piece, score, "normal") for piece, score in (
    ("▁", -3.0), ("▁▁", -4.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), ("▁a", -3.5), ("ba", -3.2), ("é", -5.0),
    ("aba", -5.0), ("▁▁a", -6.0))]]


@pytest.fixture(scope="module")
def small():
    return pieces.vocabulary(SMALL)


@pytest.fixture(scope="module")
def public():
    return pieces.load(MODEL)


def encode(texts, vocab):
    ids, counts = pieces.encode_texts(pa.array(texts, pa.string()), vocab)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def brute(text, table, unknown):
    """Best path over characters, earliest start on ties."""
    if not text:
        return []
    text = "▁" + text.replace(" ", "▁")
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for start in range(len(text)):
        for stop in range(start + 1, min(len(text), start + 20) + 1):
            number, score = table.get(text[start:stop], (None, None))
            if number is None and stop == start + 1:
                score = unknown
            if score is not None and best[start] + score > best[stop]:
                best[stop], back[stop] = best[start] + score, (start, number)
    out, at = [], len(text)
    while at:
        start, number = back[at]
        out[:0] = [number] if number is not None else [1 + byte for byte in text[start:at].encode()]
        at = start
    return out


def test_matches_plain_viterbi(small):
    table = {piece: (number, score) for number, (piece, score, kind) in enumerate(SMALL) if kind == "normal"}
    random.seed(1)
    texts = ["".join(random.choices("ab é\n☃", (5, 5, 3, 1, 1, 1), k=random.randint(0, 30))) for _ in range(400)]
    assert encode(texts, small) == [brute(text, table, -6.0 - 10) for text in texts]


def test_matches_the_library(public):
    sentencepiece = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["there is a thing", "Engeberö geverü auf schö", "日本 ok", "12 apples", "hello  world"]
    for text, ids in zip(texts, encode(texts, public)):
        best = library.nbest_encode(text, nbest_size=1)[0]
        assert public.scores[ids].sum() >= public.scores[best].sum() and library.decode(ids) == text


def test_ranks_become_log_probabilities(public):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    normal = np.array([i for i in range(library.get_piece_size()) if not (
        library.is_byte(i) or library.is_unknown(i) or library.is_control(i) or library.is_unused(i))])
    assert abs(np.exp(public.scores[normal]).sum() - 1) < 1e-9
    assert (np.diff(public.scores[normal]) < 0).all()
    given = [("a", -1.5, "normal"), ("b", -2.25, "normal"), ("<unk>", 0.0, "unknown")]
    assert not pieces.are_ranks(given) and pieces.are_ranks([("a", 0.0, "normal"), ("b", -1.0, "normal"), ("c", -2.0, "normal")])


def test_matches_the_library_on_log_scores(public):
    """The library, given the same log scores as a unigram model, takes paths of the same score."""
    sentencepiece = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for number, piece in enumerate(proto.pieces):
        piece.score = public.scores[number]
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["there is a thing", "international organisations of the world", "Engebero geveru auf schon", "12 apples", "hello  world"]
    for text, ids in zip(texts, encode(texts, public)):
        assert abs(public.scores[ids].sum() - public.scores[library.encode(text)].sum()) < 1e-3
        assert len(ids) <= 2 + len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text))


def test_trie_holds_every_piece(public):
    trie = public.trie
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    for number in range(259, 32_000, 7):
        node = 0
        for byte in library.id_to_piece(number).replace("▁", " ").encode():
            step = trie.base[node] + byte
            assert trie.check[step] == node
            node = step
        assert trie.piece[node] == number


def test_round_trip_of_all_texts(documents, public):
    rows = pieces.encode(documents.select("doc_id", "text"), public).collect()
    assert len(rows) == documents.count() and all(row.exact for row in rows)


def test_odd_rows(odd_docs, no_docs, public):
    encoded = pieces.encode(odd_docs, public)
    assert encoded.count() == odd_docs.count()
    back = pieces.decode(encoded.withColumn("decoded", encoded.text), public).select("text", "ids", "decoded", "exact").collect()
    assert all((row.text or "") == row.decoded and row.exact for row in back)
    assert all(row.ids == [] for row in back if not row.text)
    assert pieces.decode(pieces.encode(no_docs, public), public).count() == 0


def test_marker_in_text_is_a_space(spark, public):
    row = pieces.encode(spark.createDataFrame([("a▁b",)], "text string"), public).first()
    assert not row.exact and pieces.decode_ids(np.array(row.ids), np.array([len(row.ids)]), public) == [b"a b"]


def test_bad_bytes_and_null_ids(spark, small):
    rows = spark.createDataFrame([([1 + 0xFF],), (None,), ([],)], "ids array<int>")
    assert sorted((row.decoded for row in pieces.decode(rows, small).collect()), key=str) == ["", None, "�"]


def test_without_byte_pieces():
    vocab = pieces.vocabulary([("<unk>", 0.0, "unknown"), ("▁", -1.0, "normal"), ("a", -1.0, "normal")])
    assert encode(["a☃☃"], vocab) == [[1, 2, 0, 0]]
