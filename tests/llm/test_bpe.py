"""BPE against the library itself, and against the operator's edge cases."""

import hashlib
import random

import numpy as np
import pytest

from quayside.llm.bpe import Codec, Part, bpe_decode, bpe_digests, bpe_encode, cuts, join_leaves

PIECES = ["the", "of", "'re", "'s", " ", "\n", "<|endoftext|>", "<|startoftext|>", "é", "é", "İ", "Σ", "!!", "...", "1", "abc",
          "xyzzy", "thththth", "ß", "한", "\u0085", "\x1c", "–", "€", "'"]


def samples():
    rnd = random.Random(3)
    for k in range(120):
        if k % 4 == 0:
            yield "".join(rnd.choice("thandreoisg") for _ in range(rnd.randint(0, 3000)))
        elif k % 4 == 1:
            yield "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 900)))
        elif k % 4 == 2:
            yield "ab" * rnd.randint(0, 1500) + rnd.choice(PIECES) + "a" * rnd.randint(0, 1000)
        else:
            yield "".join(rnd.choice([*PIECES[:6], "!", "-", "İ"]) for _ in range(rnd.randint(0, 1500)))


@pytest.fixture(scope="module")
def codec(vocab):
    return Codec(vocab, unsplit_chars=256)


def test_ids_and_text_equal_the_library(codec):
    for text in samples():
        ids = codec.full.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert codec.decode(got) == codec.full.decode(ids, skip_special_tokens=False)


def test_tree_of_leaves_equals_the_whole(codec):
    for text in samples():
        bounds = cuts(text, 200)
        parts = [Part((np.frombuffer(codec.encode(text[a:b]), "<u4"),), a, b) for a, b in zip(bounds, bounds[1:])]
        if parts:
            assert join_leaves(codec, text, parts).columns[0].tolist() == codec.full.encode(text, add_special_tokens=False).ids


def test_every_plain_character_by_word(codec):
    for c in [*range(0x250), *range(0x2010, 0x205F), 0x20AC]:
        for text in (f"a{chr(c)}b", chr(c), chr(c) * 3 + "."):
            assert np.frombuffer(codec.encode(text), "<u4").tolist() == codec.full.encode(text, add_special_tokens=False).ids


def test_rows_long_and_short(spark, vocab, codec):
    texts = [None, "", "Hello World", "word " * 700, "x" * 5000, "Hello World", "a<|endoftext|>b " * 300]
    rows = [(i if i != 5 else 2, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = bpe_digests(docs, vocab, leaf_chars=1000).collect()
    want = []
    for i, t, _ in rows:
        ids = codec.full.encode(t or "", add_special_tokens=False).ids
        text = codec.full.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_decode_column_and_empty_table(spark, vocab):
    docs = spark.createDataFrame([(1, "Some text.", "x")], "doc_id long, text string, decoded string")
    out = bpe_decode(bpe_encode(docs, vocab).selectExpr("*", "'x' AS decoded"), vocab).collect()
    assert [r.decoded for r in out] == ["some</w> text</w> .</w>"]
    assert bpe_digests(docs.limit(0), vocab).count() == 0
