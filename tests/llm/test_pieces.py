"""SentencePiece operator against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm.pieces import CACHE_WORDS, LONG_BLANKS, PieceModel, piece_decode, piece_digests, piece_encode
from quayside.llm.registry import QUERIES
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = PieceModel(PATH)


def library(text):
    return MODEL.library.encode(text or "", add_bos=True, add_eos=True)


def packed(ids):
    return np.asarray(ids, "<u4").tobytes()


PARTS = [" ", "  ", "\n", "\t", "\0", "▁", "a", "th", "ing", "12", ",", "é", "ж", "日本", "😀", "ﬁ", "　", "́", "<s>", "<0x0A>", "ß"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=30))
def test_equals_the_library(parts):
    text = "".join(p.encode("utf-8", "ignore").decode() for p in parts)
    ids = MODEL.encode(text)
    assert ids == packed(library(text))
    assert MODEL.decode(ids) == MODEL.library.decode(library(text))


@pytest.mark.parametrize("unit", [" ", "a", "=", "-", "ab", " x", "ha", "▁", "0"])
def test_runs(unit):
    """Overlapping pairs, and pieces of blanks, which share one score."""
    for n in [*range(1, 70), LONG_BLANKS - 1, LONG_BLANKS, LONG_BLANKS + 1, 3000]:
        assert MODEL.encode(unit * n) == packed(library(unit * n)), n


def test_long_texts_and_words():
    rng = np.random.default_rng(5)
    word = "".join(rng.choice(list("abcdefghij"), 30_000))
    for text in (word, "lorem ipsum " * 60_000, "x" * 600_000, word + " " + "y" * 10 + "\n" * 999):
        assert MODEL.encode(text) == packed(library(text))


def test_batches_and_cache():
    """Texts of one batch do not touch each other; the cache stays bounded."""
    model = PieceModel(PATH)
    texts = [f"word{i} other{i % 7} {i * 7919}x" for i in range(20_000)] + [None, "", "a"]
    got = model.encode_all(texts)
    assert got == [packed(x) for x in MODEL.library.encode([t or "" for t in texts], add_bos=True, add_eos=True)]
    for i in range(0, 300_000, 50_000):
        model.encode_all([f"w{k:06d}q" for k in range(i, i + 50_000)])
    assert len(model.cache) <= CACHE_WORDS


def test_decode_of_odd_ids():
    for ids in ([], [1], [2, 2], [3], [35], [0], [198, 201], [261, 0, 261], [28705, 28705], [230, 35, 300], [1, 1, 264, 2, 264]):
        assert MODEL.decode(packed(ids)) == MODEL.library.decode(ids), ids


def test_operator(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "a  b", 7), (3, "a  b", 7), (None, "x\ny", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    out = piece_decode(piece_encode(docs, PATH), PATH).collect()
    want = sorted(((i or 0), packed(library(t)), t or "") for i, t, _ in rows)
    assert sorted((r.doc_id or 0, bytes(r.ids), r.decoded) for r in out) == want
    assert piece_digests(docs.limit(0), PATH).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_sentencepiece"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(MODEL.library.decode(ids).encode()).hexdigest()
