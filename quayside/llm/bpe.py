"""BPE encoding and decoding by tree concatenation.

The vocabulary is a public ``tokenizers`` JSON file whose path is a
parameter; nothing is trained. Results equal the library's
``encode(text, add_special_tokens=False)`` and
``decode(ids, skip_special_tokens=False)``.

* A text of at most ``leaf_chars`` characters is encoded in the task that
  reads it. Texts inside the plain character range go word by word through
  a bounded cache (the vocabulary's normaliser and splitter treat every such
  character on its own); other texts go through the library as they are.
* A longer text is cut into leaves, which become rows of their own and are
  encoded by parallel tasks. The leaves of one text are then joined in pairs
  up a binary tree: a window around each cut is encoded again and grown until
  its tokens agree, in id and place, with the tokens of both sides.
* A single unsplit word longer than ``unsplit_chars`` is encoded by the same
  tree inside the task.

Why agreement is enough: the window starts and ends at tokens of the sides,
the agreeing tokens lie beyond ``MARGIN`` characters from the cut (longer
than any special token), and in a merge-rank BPE a token sequence is the
encoding of its text exactly when each neighbouring pair is the encoding of
its own concatenation. Every pair of the joined sequence occurs in a side or
in the window.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; repeated rows give repeated rows; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import releasing, slices, with_column

LEAF_CHARS = 32768
UNSPLIT_CHARS = 2048
MARGIN = 64
CACHE_WORDS = 50_000

# Fixed value: the splitter pattern of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters whose normal form, lower case and class do not depend on their
# neighbours: up to U+024F, general punctuation and the euro sign.
OUTSIDE_PLAIN = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")

BLANK_LETTER = re.compile("[ \n][a-zA-Z]")

Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, first and end character of each token


class WordCache(dict):
    """Ids by word, in two generations of at most CACHE_WORDS words each."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, vocab_path: str, unsplit_chars: int = UNSPLIT_CHARS):
        import regex
        import tokenizers

        with open(vocab_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.full = tokenizers.Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        # the same model (shared, not copied) without normaliser and added tokens
        self.merges = tokenizers.Tokenizer(self.full.model)
        if self.full.pre_tokenizer is not None:
            self.merges.pre_tokenizer = self.full.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        # the word path holds for the vocabulary's own normaliser and splitter only
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        patterns = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and patterns[:1] == [WORD_PATTERN]
        self.plain_words = plain_pattern(regex)
        self.unsplit_chars = unsplit_chars
        self.token = {i: t for t, i in self.full.get_vocab(with_added_tokens=True).items()}
        self.ids_of = WordCache(self._word)
        self.joiner = " " if spec.get("decoder") is None else None

    # whole texts ---------------------------------------------------------
    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.special_split:
            return self._encode_segment(text)
        return b"".join(int(self.special[s]).to_bytes(4, "little") if s in self.special else self._encode_segment(s)
                        for s in self.special_split.split(text) if s)

    def _encode_segment(self, text: str) -> bytes:
        if not self.by_word or OUTSIDE_PLAIN.search(text):
            return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.ids_of.__getitem__, self.plain_words.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if len(word) > self.unsplit_chars:
            return _ids_bytes(self.encode_unsplit(word))
        return array("I", self.merges.encode(word, add_special_tokens=False).ids).tobytes()

    def decode(self, ids: bytes) -> str:
        """Text of ids packed as by ``encode``."""
        values = np.frombuffer(ids, "<u4").tolist()
        if self.joiner is None:
            return self.full.decode(values, skip_special_tokens=False)
        return self.joiner.join(map(self.token.__getitem__, values))

    # tokens with their places --------------------------------------------
    def tokens(self, text: str, base: int = 0) -> Tokens:
        """Ids of ``text`` with the characters each token covers."""
        parts: list[Tokens] = []
        at = base
        for s in (self.special_split.split(text) if self.special_split else [text]):
            if s in self.special:
                parts.append((np.array([self.special[s]], np.int64), np.array([at]), np.array([at + len(s)])))
            elif s and self.by_word and not OUTSIDE_PLAIN.search(s):
                lower = s.lower()
                if len(lower) == len(s):
                    for m in self.plain_words.finditer(lower):
                        parts.append(self._word_tokens(m.group(), at + m.start()))
                else:  # a character whose lower case is longer
                    parts.append(self._library_tokens(self.full, s, at))
            elif s:
                parts.append(self._library_tokens(self.full, s, at))
            at += len(s)
        return concat(parts)

    def _word_tokens(self, word: str, at: int) -> Tokens:
        if len(word) > self.unsplit_chars:
            ids, first, end = self.encode_unsplit(word)
            return ids, first + at, end + at
        return self._library_tokens(self.merges, word, at)

    @staticmethod
    def _library_tokens(tokenizer, text: str, at: int) -> Tokens:
        e = tokenizer.encode(text, add_special_tokens=False)
        places = np.asarray(e.offsets, np.int64).reshape(-1, 2) + at
        return np.asarray(e.ids, np.int64), places[:, 0], places[:, 1]

    def encode_unsplit(self, word: str) -> Tokens:
        """One long unsplit word, by halves. It has no place that is known to
        part two words, so the parts keep the places of all their tokens."""
        def encode(first: int, end: int) -> Tokens:
            return self._library_tokens(self.merges, word[first:end], first)

        def edge(part: Part, chars: int, at_end: bool) -> Tokens:
            _, first, end = part.columns
            if at_end:
                return _rows(part.columns, slice(int(np.searchsorted(first, part.end - chars)), None))
            return _rows(part.columns, slice(0, int(np.searchsorted(end, part.first + chars, side="right"))))

        def grow(first: int, end: int) -> Part:
            if end - first <= self.unsplit_chars:
                return Part(encode(first, end), first, end)
            cut = (first + end) // 2
            return join(grow(first, cut), grow(cut, end), edge, encode)

        return grow(0, len(word)).columns

    def edge(self, text: str, part: Part, chars: int, at_end: bool) -> Tokens:
        """Tokens of about ``chars`` characters at an end of a part, up to a
        blank before an ASCII letter: words end there, so a part's tokens on
        either side of it are those of the text on that side."""
        first, end = part.first, part.end
        if self.by_word and end - first > 2 * chars:
            if at_end:
                m = BLANK_LETTER.search(text, end - 2 * chars, end - chars)
            else:
                m = BLANK_LETTER.search(text, first + chars, first + 2 * chars)
            if m and at_end:
                first = m.start() + 1
            elif m:
                end = m.start() + 1
            else:
                return self.edge(text, part, 2 * chars, at_end)
        return self.tokens(text[first:end], first)


@dataclass
class Part:
    """The tokens of text[first:end]: their ids, and their places if kept."""

    columns: tuple[np.ndarray, ...]
    first: int
    end: int


def join(left: Part, right: Part, edge, encode, agree: int = 4) -> Part:
    """One part from two neighbours.

    ``edge(part, chars, at_end)`` gives the tokens at an end of a part,
    ``encode(a, b)`` those of text[a:b]. The window spans an edge of each side
    and grows by doubling until ``agree`` tokens at each of its ends, all
    beyond the margin from the cut, are the sides' own; a side that it covers
    whole needs no agreement.
    """
    chars = 4 * MARGIN
    while True:
        before, after = edge(left, chars, True), edge(right, chars, False)
        n_left, n_right = len(left.columns[0]), len(right.columns[0])
        whole_left, whole_right = len(before[0]) >= n_left, len(after[0]) >= n_right
        start = left.first if whole_left or not len(before[0]) else int(before[1][0])
        stop = right.end if whole_right or not len(after[0]) else int(after[2][-1])
        inside = encode(start, stop)
        if (whole_left or _agree(before, inside, slice(0, agree), left.end - MARGIN, None)) and \
                (whole_right or _agree(after, inside, slice(-agree, None), None, left.end + MARGIN)):
            columns = [np.concatenate([l[:max(0, n_left - len(before[0]))], w, r[len(after[0]):]])
                       for l, w, r in zip(left.columns, inside, right.columns)]
            return Part(tuple(columns), left.first, right.end)
        chars *= 2


def _rows(columns, rows: slice):
    return tuple(c[rows] for c in columns)


def _agree(side: Tokens, inside: Tokens, rows: slice, before: int | None, after: int | None) -> bool:
    (ids, first, end), own = _rows(side, rows), _rows(inside, rows)
    n = abs(rows.stop or rows.start)
    return len(ids) == n and (before is None or end[-1] <= before) and (after is None or first[0] >= after) \
        and all(np.array_equal(a, b) for a, b in zip((ids, first, end), own))


def concat(parts: list[Tokens]) -> Tokens:
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(column) for column in zip(*parts))  # type: ignore[return-value]


def codec(vocab_path: str) -> Codec:
    """One codec of the running task (of the worker process, where texts are joined)."""
    if vocab_path not in _CODECS:
        _CODECS[vocab_path] = Codec(vocab_path)
    return _CODECS[vocab_path]


_CODECS: dict[str, Codec] = {}


def plain_pattern(regex) -> re.Pattern:
    """``WORD_PATTERN`` for plain characters, with the classes spelt out as
    ranges (several times faster). Contractions start with an apostrophe,
    which is in neither class, so they need not come first."""
    # what lower-casing a plain text can give; a few capitals' small letters lie outside the range
    plain = sorted({x for c in map(chr, range(0x2100)) if not OUTSIDE_PLAIN.search(c) for x in c.lower()})

    def cls(pattern: str) -> str:
        return "".join(f"\\u{ord(c):04x}" for c in plain if regex.fullmatch(pattern, c))

    return re.compile(f"[{cls(r'\p{L}')}]+|[{cls(r'\p{N}')}]|'(?:s|t|re|ve|m|ll|d)|[{cls(r'[^\s\p{L}\p{N}]')}]+")


def cuts(text: str, leaf_chars: int) -> list[int]:
    """Bounds of the leaves: about ``leaf_chars`` apart, each moved on to the
    next ASCII character so that no composed character is cut."""
    out, at = [0], leaf_chars
    plain = re.compile("[\x00-\x7f]")
    while at < len(text):
        m = plain.search(text, at)
        if not m or m.start() >= len(text):
            break
        out.append(m.start())
        at = m.start() + leaf_chars
    return [*out, len(text)]


def join_leaves(codec: Codec, text: str, parts: list[Part]) -> Part:
    """Join neighbouring parts pairwise, level by level."""
    def encode(first: int, end: int) -> Tokens:
        return codec.tokens(text[first:end], first)

    def edge(part: Part, chars: int, at_end: bool) -> Tokens:
        return codec.edge(text, part, chars, at_end)

    while len(parts) > 1:
        parts = [join(*pair, edge, encode) if len(pair) == 2 else pair[0]
                 for pair in (parts[k:k + 2] for k in range(0, len(parts), 2))]
    return parts[0]


def _ids_bytes(tokens: Tokens) -> bytes:
    return tokens[0].astype("<u4").tobytes()


def bpe_encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
               leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(id_col, ids): the ids of each text as little-endian uint32 bytes."""
    short, long = _split(docs, id_col, text_col, leaf_chars)

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(slices(batches, "_text"), _CODECS):
            ids = pa.array([codec(vocab_path).encode(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return short.mapInArrow(encode_short, f"`{id_col}` {kind}, ids binary").unionByName(
        _encode_long(long, vocab_path, id_col, kind, leaf_chars, lambda ids: {"ids": ids}, "ids binary"))


def _split(docs: DataFrame, id_col: str, text_col: str, leaf_chars: int) -> tuple[DataFrame, DataFrame]:
    """Texts that one task encodes as they are, and texts that are cut into leaves."""
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    short = texts.filter(F.coalesce(F.length("_text"), F.lit(0)) <= leaf_chars).select(id_col, "_text")
    long = texts.filter(F.length("_text") > leaf_chars)
    return short, long


def _encode_long(long: DataFrame, vocab_path: str, id_col: str, kind: str, leaf_chars: int, columns: Callable[[bytes], dict],
                 schema: str) -> DataFrame:
    """``id_col`` and what ``columns`` makes of the ids of each long text, in the task that joins its leaves."""
    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text, row in batch.itertuples(index=False):
                bounds = cuts(text, leaf_chars)
                parts = list(zip(bounds, bounds[1:]))
                yield pd.DataFrame({"_id": [key] * len(parts), "_row": row, "_n": range(len(parts)),
                                    "_text": [text[a:b] for a, b in parts]})

    def encode_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in releasing(batches, _CODECS):
            yield batch.assign(_ids=[codec(vocab_path).encode(t) for t in batch["_text"]])

    def join_text(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_n")
        ends = np.cumsum(group["_text"].str.len())
        parts = [Part((np.frombuffer(ids, "<u4"),), end - len(text), end)
                 for ids, text, end in zip(group["_ids"], group["_text"], ends.tolist())]
        whole = join_leaves(codec(vocab_path), "".join(group["_text"]), parts)
        made = columns(whole.columns[0].astype("<u4").tobytes())
        return pd.DataFrame({id_col: group["_id"].iloc[:1]} | {name: [value] for name, value in made.items()})

    leaf_rows = long.mapInPandas(leaves, f"_id {kind}, _row long, _n long, _text string").repartition("_row", "_n")
    encoded = leaf_rows.mapInPandas(encode_leaf, f"_id {kind}, _row long, _n long, _text string, _ids binary")
    return encoded.groupBy("_row").applyInPandas(join_text, f"`{id_col}` {kind}, {schema}")


def bpe_decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text that the ids decode to."""
    encoded = encoded.drop(text_col)
    schema = with_column(encoded, text_col, "string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(batches, _CODECS):
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([codec(vocab_path).decode(x or b"") for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(decode, schema)


def bpe_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                leaf_chars: int = LEAF_CHARS, keep_ids: bool = False) -> DataFrame:
    """Per document: n_tokens, ids_sha256 and decoded_sha256 (lower-case hex),
    and the ids themselves if they are to be kept. A text that is not cut is
    encoded and digested by one Python stage, and a cut one by that which joins
    it, so a task has one worker."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if keep_ids else "")

    def digests(ids: bytes) -> dict:
        decoded = codec(vocab_path).decode(ids).encode()
        return {"n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded).hexdigest()} | ({"ids": ids} if keep_ids else {})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in releasing(slices(batches, "_text", 1 << 20), _CODECS):
            made = [digests(codec(vocab_path).encode(t)) for t in batch.column(1).to_pylist()]
            columns = pa.RecordBatch.from_pylist(made, pa.schema(
                [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary())][:4 if keep_ids else 3]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns.columns], names=[id_col, *columns.schema.names])

    short, long = _split(docs, id_col, text_col, leaf_chars)
    return short.mapInArrow(whole, f"`{id_col}` {kind}, {schema}").unionByName(
        _encode_long(long, vocab_path, id_col, kind, leaf_chars, digests, schema))
