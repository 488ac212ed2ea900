"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model is a public ``sentencepiece`` file whose path is a parameter;
nothing is trained. Results equal the library's ``encode(text, add_bos=True,
add_eos=True)`` without sampling and ``decode(ids)``.

A text is normalised as the model does it (a blank before it, blanks written
as U+2581) and cut into words where no piece of the vocabulary can reach
across: before a blank that follows another character, and around characters
that occur in no piece of several characters. All words of a batch that are
not in the bounded cache are encoded together, in flat numpy arrays of
symbols: in a round every word finds the least rank among its neighbouring
pairs (a segmented minimum) and merges all its pairs of that rank, leftmost
first and without overlap; finished words leave the arrays, and the rounds end
when no word has a pair left. The library takes one pair at a time, the best
score first and of equal ones the leftmost. So where a merge makes a pair that
is as good as its own rank or better, the word's later merges wait for the
next round; otherwise their order does not matter. What is then no piece is
written as the bytes of its characters.

Defined cases: a null text counts as empty; an empty text has the begin and
the end id only and decodes to the empty string; repeated rows give repeated
rows; an empty table gives an empty result; other columns are ignored. A long
text goes part by part (cut between words), so memory is bounded by its longest word; a
word of n characters takes at most n rounds over its symbols.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import slices, with_column

BLANK = "▁"
NEVER = np.int32(2**31 - 1)  # rank of a pair that does not merge
CACHE_WORDS = 120_000
PART_CHARS = 1 << 18
LONG_BLANKS = 256

# Texts whose ids are compared with the library's when a model is read.
PROBES = ["", " ", "a  b   c ", "Ab cd\n\tef", "ﬁ Å 1 234,5", "x" * 40, " é日本語ж ▁ <s> <0x0A>", " " * 37 + "x"]


class PieceModel:
    """Ranks, symbols and bytes of one model file, and a cache of words."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): i for i in plain}
        self.bos, self.eos = (np.uint32(i).tobytes() for i in (sp.bos_id(), sp.eos_id()))
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        inside = {c for p in pieces if len(p) > 1 for c in p}
        # symbols: the pieces, the single characters of pieces, and one for any other character
        names = list(pieces) + sorted(inside - pieces.keys())
        symbol = {name: k for k, name in enumerate(names)}
        self.count = len(names) + 1
        self.id_of = np.array([pieces.get(name, -1) for name in names] + [-1], np.int64)
        self.symbol_of = np.full(0x110000, len(names), np.int32)
        for name, k in symbol.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = k
        score = np.array([sp.get_score(i) for i in pieces.values()])
        rank = dict(zip(pieces, np.unique(-score, return_inverse=True)[1].tolist()))
        pairs = sorted((symbol[p[:cut]] * self.count + symbol[p[cut:]], rank[p], symbol[p])
                       for p in pieces for cut in range(1, len(p)) if p[:cut] in symbol and p[cut:] in symbol)
        self.keys = np.array([x[0] for x in pairs] + [2**62], np.int64)
        self.ranks = np.array([x[1] for x in pairs] + [NEVER], np.int32)
        self.into = np.array([x[2] for x in pairs] + [0], np.int32)
        self.surface = [self._surface(i) for i in range(size)]
        self.words = re.compile(self._word_pattern(pieces, inside))
        self.cache: dict[str, bytes] = {}
        if any(self.encode(t) != np.asarray(sp.encode(t, add_bos=True, add_eos=True), "<u4").tobytes() for t in PROBES):
            raise ValueError(f"{model_path} is not a BPE model with byte fallback, a blank prefix and no other normalising")

    def _surface(self, i: int) -> bytes | None:
        """Bytes that an id decodes to; None where the library has to say."""
        sp = self.library
        if sp.is_control(i):
            return b""
        if sp.is_byte(i):
            return bytes([int(sp.id_to_piece(i)[3:5], 16)])
        return None if sp.is_unknown(i) else sp.id_to_piece(i).replace(BLANK, " ").encode()

    @staticmethod
    def _word_pattern(pieces: dict[str, int], inside: set[str]) -> str:
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in inside))
        if any(BLANK in p.lstrip(BLANK) for p in pieces):  # pieces reach across blanks
            return f"[^{alone}]+|[{alone}]"
        return f"{BLANK}+[^{BLANK}{alone}]*|[^{BLANK}{alone}]+|[{alone}]"

    # encoding --------------------------------------------------------------
    def parts(self, text: str) -> Iterator[list[str]]:
        """Words of the normalised text, in lists of bounded size."""
        if not text:
            return
        text, at = BLANK + text.replace(" ", BLANK), 0
        while at < len(text):
            end = at + PART_CHARS
            if end < len(text):  # a word that may go on past the part is left for the next one
                words = self.words.findall(text, at, end)
                while len(words) < 2 and end < len(text):
                    end += end - at
                    words = self.words.findall(text, at, min(end, len(text)))
                if end < len(text):
                    words.pop()
            else:
                words = self.words.findall(text, at)
            at += sum(map(len, words))
            yield words

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of all the words, from the cache and encoded together."""
        ids = {w: self.cache[w] for w in words if w in self.cache}
        new = [w for w in words if w not in ids]
        ids.update(zip(new, self.merge(new)))
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = {}
        if len(ids) <= CACHE_WORDS:
            self.cache.update((w, x) for w, x in ids.items() if len(w) <= 32)
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        out: list[list[bytes]] = [[self.bos] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def flush() -> None:
            nonlocal chars
            ids = self.learn({w for _, words in waiting for w in words})
            for k, words in waiting:
                out[k].append(b"".join(map(ids.__getitem__, words)))
            waiting.clear()
            chars = 0

        for k, text in enumerate(texts):
            for words in self.parts(text or ""):
                waiting.append((k, words))
                chars += sum(map(len, words))
                if chars >= 4 * PART_CHARS:
                    flush()
        flush()
        return [b"".join([*ids, self.eos]) for ids in out]

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.count + right
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.ranks[place], NEVER), self.into[place]

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word (in its normalised form), by rounds of merges."""
        blanks = {k: self._by_library(w) for k, w in enumerate(words) if w.startswith(BLANK * (LONG_BLANKS + 1))}
        if blanks:
            others = iter(self.merge([w for k, w in enumerate(words) if k not in blanks]))
            return [blanks[k] if k in blanks else next(others) for k in range(len(words))]
        if not words:
            return []
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, at = self.symbol_of[code], np.arange(len(code))
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        owner = word
        rank, into = np.full(len(sym), NEVER), np.zeros(len(sym), np.int32)

        def pair(places: np.ndarray) -> None:
            """Rank and result of the pairs that start at these places."""
            places = places[places + 1 < len(sym)]
            ranks, made = self._lookup(sym[places], sym[places + 1])
            rank[places] = np.where(word[places] == word[places + 1], ranks, NEVER)
            into[places] = made

        pair(np.arange(len(sym)))
        finished = []
        while True:
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            least = np.minimum.reduceat(rank, starts)
            active = least < NEVER
            if not active.all():  # compaction: finished words leave
                stay = np.repeat(active, sizes)
                finished.append((at[~stay], sym[~stay]))
                sym, at, word, rank, into = (x[stay] for x in (sym, at, word, rank, into))
                least, sizes = least[active], sizes[active]
            if not len(sym):
                break
            pick = self._leftmost(np.flatnonzero(rank == np.repeat(least, sizes)))
            pick = self._in_order(pick, sym, word, rank, into)
            sym[pick] = into[pick]
            stay = np.ones(len(sym), bool)
            stay[pick + 1] = False
            sym, at, word, rank, into = (x[stay] for x in (sym, at, word, rank, into))
            made = pick - np.arange(len(pick))
            rank[made] = NEVER  # where a merged symbol is the last of all
            pair(np.concatenate([made, made[made > 0] - 1]))
        at, sym = (np.concatenate(x) for x in zip(*finished))
        order = np.argsort(at)
        return self._ids(code, owner, at[order], sym[order], len(words))

    def _by_library(self, word: str) -> bytes:
        return np.asarray(self.library.encode(word[1:].replace(BLANK, " ")), "<u4").tobytes()

    @staticmethod
    def _leftmost(places: np.ndarray) -> np.ndarray:
        """Of pairs that overlap in a run, every second one from the left."""
        number = np.arange(len(places))
        first = np.maximum.accumulate(np.where(np.r_[True, np.diff(places) != 1], number, 0))
        return places[(number - first) % 2 == 0]

    def _in_order(self, pick: np.ndarray, sym, word, rank, into) -> np.ndarray:
        """The merges of a round up to the first in each word that makes a pair
        as good as its own or better."""
        own, made, of = rank[pick], into[pick], word[pick]
        after = np.minimum(pick + 2, len(sym) - 1)
        right = np.where((pick + 2 < len(sym)) & (word[after] == of), self._lookup(made, sym[after])[0], NEVER)
        before = np.maximum(pick - 1, 0)
        merged = np.r_[False, np.diff(pick) == 2]
        neighbour = np.where(merged, np.r_[made[:1], made[:-1]], sym[before])
        left = np.where((pick > 0) & (word[before] == of), self._lookup(neighbour, made)[0], NEVER)
        ends = (right <= own) | (left <= own)
        if not ends.any():
            return pick
        earlier = np.cumsum(ends) - ends
        base = np.maximum.accumulate(np.where(np.r_[True, of[1:] != of[:-1]], earlier, 0))
        return pick[earlier == base]

    def _ids(self, code, owner, at, sym, n: int) -> list[bytes]:
        """Ids of final symbols, byte by byte where a symbol is no piece."""
        ids, spelt = self.id_of[sym], code[at]
        lone = ids < 0
        width = np.where(lone, 1 + (spelt > 0x7F) + (spelt > 0x7FF) + (spelt > 0xFFFF), 1)
        ends = np.cumsum(width)
        out = np.repeat(ids, width)
        for c in np.unique(spelt[lone]):
            raw = self.byte_id[np.frombuffer(chr(c).encode(), np.uint8)]
            out[(ends[lone & (spelt == c)] - len(raw))[:, None] + np.arange(len(raw))] = raw
        data = out.astype("<u4").tobytes()
        cut = (4 * np.cumsum(np.bincount(owner[at], weights=width, minlength=n))).astype(np.int64).tolist()
        return [data[a:b] for a, b in zip([0, *cut], cut)]

    # decoding --------------------------------------------------------------
    def decode(self, ids: bytes) -> str:
        """Text of ids packed as by ``encode``."""
        values = np.frombuffer(ids, "<u4").tolist()
        found = [self.surface[i] for i in values]
        first = next((k for k, x in enumerate(found) if x != b""), None)
        if first is None:
            return ""
        try:
            if None in found or self.library.is_byte(values[first]):
                return self.library.decode(values)
            text = b"".join(found).decode()
        except UnicodeDecodeError:
            return self.library.decode(values)
        return text.removeprefix(" ")


_MODELS: dict[str, PieceModel] = {}


def model(model_path: str) -> PieceModel:
    """One model in a worker process, kept from task to task with its cache."""
    if model_path not in _MODELS:
        _MODELS[model_path] = PieceModel(model_path)
    return _MODELS[model_path]


def piece_encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids): the ids of each text as little-endian uint32 bytes."""
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            ids = model(model_path).encode_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    return texts.mapInArrow(encode, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary")


def piece_decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text that the ids decode to."""
    encoded = encoded.drop(text_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ids_col):
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([model(model_path).decode(x or b"") for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(decode, with_column(encoded, text_col, "string"))


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, ids_sha256 and decoded_sha256 (lower-case hex).
    Encodes and decodes in one stage, so no ids leave a task."""
    texts = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            codec = model(model_path)
            ids = codec.encode_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(codec.decode(x).encode()).hexdigest() for x in ids], pa.string())], names=names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(digest, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
