"""Exact substring dedup with a logarithmic family of suffix arrays.

Every byte that lies in a ``length``-byte string which also starts in a
document of smaller id is removed. Texts are UTF-8 bytes; matches never cross
documents; strings are judged on the input.

1. Documents are dealt into batches by a hash. In a batch, each window of
   ``length`` bytes is charged to its anchor, the leftmost of the least-hashed
   ``GRAM``-byte strings in it. Equal windows have equal anchors, and about one
   place in fifteen is an anchor. Anchors that occur in one document only
   cannot be in a match: the batches send their anchors' hashes to buckets by
   hash and get back, in order, which are shared.
2. For a shared anchor a batch sends the text of the windows charged to it,
   once for equal texts, with the smallest id that has it. A bucket indexes
   them in order of the ids: each new portion gets a suffix array (the starts
   of its windows, sorted by the ``length`` bytes from there), is merge-scanned
   against the levels of the index for equal windows, and the windows that are
   new become a level; levels of like size merge, so their sizes grow
   geometrically. The bucket answers, per window, whether a smaller id has it.
3. The batches mark the windows, join what they cover, and cut it out.

All three steps are one plan in which the shuffled texts are reused. A text
moves once, an anchor as 9 bytes, and only shared text moves again. An anchor
shared by very many different texts is dealt by whole windows instead, so no
bucket has to hold them all.

Defined cases: a null text is empty; texts shorter than ``length`` lose
nothing; a null id sorts after all others; rows of equal id do not remove
from one another; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import mix, text_buffer

LENGTH = 50
GRAM = 20
BATCH_BYTES = 8 << 20
LEAST_BATCHES = 64
PART_BYTES = 1 << 20  # of texts worked on at a time in a batch
PORTION = 200_000  # windows of a portion
HOT_TEXTS = 50_000  # an anchor with about so many texts is dealt by windows
LAST = np.iinfo(np.int64).max  # stands for a null id
KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


# anchors -------------------------------------------------------------------
@dataclass
class Runs:
    """Runs of windows with one anchor: windows first to end - 1 of document doc."""

    first: np.ndarray
    end: np.ndarray
    key: np.ndarray  # hash of the anchor
    doc: np.ndarray


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place (three overlapping words of 8)."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    return mix(words[:n] * KEYS[0] + mix(words[8:8 + n] * KEYS[1] + words[GRAM - 8:GRAM - 8 + n] * KEYS[2]))


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    """Of all texts data[offsets[i]:offsets[i + 1]], some at a time."""
    parts, i = [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PART_BYTES, side="right")) - 1)
        parts.append(_runs(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], int(offsets[i]), i, length))
        i = j
    parts = [p for p in parts if p is not None]
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(np.uint64), none)
    return Runs(*(np.concatenate(c) for c in zip(*((p.first, p.end, p.key, p.doc) for p in parts))))


def _runs(data: np.ndarray, offsets: np.ndarray, at: int, doc: int, length: int) -> Runs | None:
    sizes = np.diff(offsets)
    has = np.flatnonzero(sizes >= length)
    if not len(has):
        return None
    hashes = gram_hashes(data)
    ranked = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)  # ties to the left
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:  # least of ever wider stretches
        ranked = np.minimum(ranked[:-width], ranked[width:])
        width *= 2
    if width < span:
        ranked = np.minimum(ranked[:width - span], ranked[span - width:])
    counts = sizes[has] - length + 1
    before = np.cumsum(counts) - counts
    window = np.arange(counts.sum()) + np.repeat(offsets[has] - before, counts)
    owner = np.repeat(has, counts)
    anchor = (ranked[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    starts = np.flatnonzero(new)
    size = np.diff(np.append(starts, len(window)))
    first = window[starts]
    return Runs(first + at, first + size + at, hashes[anchor[starts]], owner[starts] + doc)


# batches -------------------------------------------------------------------
@dataclass
class Batch:
    """The texts of a batch in an order that every step finds again."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    runs: Runs
    original: pa.Array

    @classmethod
    def of(cls, table: pa.Table, length: int) -> Batch:
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])).combine_chunks()
        text = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        data, offsets = text_buffer(text if isinstance(text, pa.Array) else text.chunk(0))
        ids = table.column("doc_id").fill_null(LAST).to_numpy()
        return cls(ids, data, offsets, runs_of(data, offsets, length), table.column("doc_id"))

    def anchors(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes by bucket and hash; the bounds of the buckets
        among them; and the anchor of each run."""
        keys, inverse = np.unique(self.runs.key, return_inverse=True)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        return keys[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), place[inverse]

    def notes(self, run_key: np.ndarray, n: int) -> np.ndarray:
        """On each anchor, 128 if it is in several documents, plus the binary
        logarithm of the number of its runs."""
        ids = self.ids[self.runs.doc]
        least, most = np.full(n, LAST), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(least, run_key, ids)
        np.maximum.at(most, run_key, ids)
        return np.log2(np.bincount(run_key, minlength=n)).astype(np.uint8) | np.where(least != most, 128, 0).astype(np.uint8)

    def texts(self, answer: np.ndarray, run_key: np.ndarray, buckets: int, length: int):
        """The distinct texts that stand for the shared runs: a run's whole
        text, or each of its windows where its anchor is hot.

        Returns per text its bytes, smallest id and bucket, and per shared run
        or window: its text, its document, its first window and their number.
        """
        known: dict[bytes, int] = {}
        least, bucket, items = [], [], []
        runs, data = self.runs, self.data.tobytes()
        shared = np.flatnonzero(answer[run_key])
        kind = answer[run_key[shared]].tolist()
        columns = (runs.first[shared], runs.end[shared], runs.key[shared] % np.uint64(buckets), self.ids[runs.doc[shared]])
        for k, first, end, to, own in zip(kind, *(c.tolist() for c in columns)):
            for a, b in ((first, end),) if k == 1 else zip(range(first, end), range(first + 1, end + 1)):
                text = data[a:b - 1 + length]
                t = known.setdefault(text, len(known))
                if t == len(least):
                    least.append(own)
                    bucket.append(to if k == 1 else int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little") % buckets)
                elif own < least[t]:
                    least[t] = own
                items.append((t, own, a, b - a))
        return list(known), np.array(least, np.int64), np.array(bucket, np.int64), np.array(items, np.int64).reshape(-1, 4)


def by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({k: pa.array(v, kinds[k]) for k, v in columns.items()})


# buckets -------------------------------------------------------------------
def shared_anchors(table):
    """Per batch and anchor, in the order sent: 0 in one document only, 1
    shared, 2 shared by very many texts."""
    blobs = table.column("sent").to_pylist()
    sizes = [len(b) // 9 for b in blobs]
    keys = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, sizes)])
    notes = np.concatenate([np.frombuffer(b, np.uint8, n, 8 * n) for b, n in zip(blobs, sizes)])
    distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    several = np.bincount(inverse, weights=notes >> 7, minlength=len(distinct)) > 0
    texts = np.bincount(inverse, weights=2.0 ** (notes & 127), minlength=len(distinct))
    answer = np.where((counts > 1) | several, np.where(texts >= HOT_TEXTS, 2, 1), 0).astype(np.uint8)[inverse]
    cuts = np.cumsum([0, *sizes])
    return _rows({"batch": table.column("batch").to_pylist(), "bucket": table.column("bucket").to_pylist(),
                  "step": [1] * len(blobs), "answer": [answer[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]}, ANSWER)


ANSWER = {"batch": pa.int64(), "bucket": pa.int32(), "step": pa.int32(), "answer": pa.binary()}
SENT = {"bucket": pa.int32(), "batch": pa.int64(), "sent": pa.binary()}
ANSWER_DDL, SENT_DDL = "batch long, bucket int, step int, answer binary", "bucket int, batch long, sent binary"


class IndexFamily:
    """Suffix arrays of growing size. A level is its windows, sorted, and the
    smallest id of each."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Index a portion, whose ids are at least those indexed before. Returns
        the smallest id that has each window, so far."""
        order = np.argsort(windows, kind="stable")  # the portion's suffix array
        ranked = windows[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        distinct, least = ranked[starts], np.minimum.reduceat(ids[order], starts)
        new = np.ones(len(distinct), bool)
        for held, held_ids in self.levels:
            at = np.minimum(np.searchsorted(held, distinct), len(held) - 1)
            hit = held[at] == distinct
            least[hit] = np.minimum(least[hit], held_ids[at[hit]])
            new &= ~hit
        out = np.empty(len(windows), np.int64)
        out[order] = np.repeat(least, np.diff(np.append(starts, len(ranked))))
        if new.any():
            self.levels.append((distinct[new], least[new]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, a_ids), (b, b_ids) = self.levels.pop(), self.levels.pop()
            both = np.concatenate([b, a])
            order = np.argsort(both, kind="stable")  # two sorted stretches: a merge
            self.levels.append((both[order], np.concatenate([b_ids, a_ids])[order]))
        return out


def older_windows(table: pa.Table, length: int) -> pa.Table:
    """Per batch and text, in the order sent: a bit for each window that a
    smaller id than the text's has."""
    blobs = table.column("sent").to_pylist()
    counts = [int.from_bytes(b[:4], "little") for b in blobs]
    ids = np.concatenate([np.frombuffer(b, "<i8", n, 4) for b, n in zip(blobs, counts)])
    sizes = np.concatenate([np.frombuffer(b, "<u2", n, 4 + 8 * n) for b, n in zip(blobs, counts)]).astype(np.int64)
    data = np.frombuffer(b"".join(b[4 + 10 * n:] for b, n in zip(blobs, counts)), np.uint8)
    starts = np.cumsum(sizes) - sizes
    # equal texts of several batches are indexed once, for the smallest id; a larger id's windows are then all older
    order = np.argsort(ids, kind="stable")
    joined, known = data.tobytes(), {}
    same = np.empty(len(ids), np.int64)
    for i, first, end in zip(order.tolist(), starts[order].tolist(), (starts + sizes)[order].tolist()):
        same[i] = known.setdefault(joined[first:end], i)
    del known
    distinct = order[same[order] == order]
    bits = np.zeros(len(ids), np.uint64)
    portion = np.cumsum(sizes[distinct] - length + 1) // PORTION
    family = IndexFamily()
    for some in np.split(distinct, np.flatnonzero(np.diff(portion)) + 1):
        windows = sizes[some] - length + 1
        place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        rows = data[(np.repeat(starts[some], windows) + place)[:, None] + np.arange(length)]
        own = np.repeat(ids[some], windows)
        older = family.add(rows.view(f"S{length}").ravel(), own) < own
        np.bitwise_or.at(bits, np.repeat(some, windows)[older], np.uint64(1) << place[older].astype(np.uint64))
    bits = np.where(ids > ids[same], ~np.uint64(0), bits[same])
    cuts = np.cumsum([0, *counts])
    return _rows({"batch": table.column("batch").to_pylist(), "bucket": table.column("bucket").to_pylist(),
                  "step": [2] * len(blobs), "answer": [bits[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]}, ANSWER)


# the three steps of a batch --------------------------------------------------
def send_anchors(number: int, batch: Batch, buckets: int) -> pa.Table:
    keys, cuts, run_key = batch.anchors(buckets)
    notes = batch.notes(run_key, len(keys))
    full = np.flatnonzero(np.diff(cuts))
    return _rows({"bucket": full, "batch": [number] * len(full),
                  "sent": [keys[cuts[k]:cuts[k + 1]].tobytes() + notes[cuts[k]:cuts[k + 1]].tobytes() for k in full]}, SENT)


def _answers(table: pa.Table, step: int, cuts: np.ndarray, kind) -> np.ndarray:
    """The answers of a step, put together in the order of the buckets."""
    out = np.zeros(cuts[-1], kind)
    for bucket, number, answer in zip(table.column("bucket").to_pylist(), table.column("step").to_pylist(), table.column("answer").to_pylist()):
        if number == step:
            out[cuts[bucket]:cuts[bucket + 1]] = np.frombuffer(answer, kind)
    return out


def send_texts(number: int, batch: Batch, answers: pa.Table, buckets: int, length: int) -> pa.Table:
    _, cuts, run_key = batch.anchors(buckets)
    texts, least, bucket, _ = batch.texts(_answers(answers, 1, cuts, np.uint8), run_key, buckets, length)
    order, cuts = by_bucket(bucket, buckets)
    sent, full = [], np.flatnonzero(np.diff(cuts))
    for k in full:
        own = order[cuts[k]:cuts[k + 1]]
        mine = [texts[i] for i in own]
        sent.append(len(own).to_bytes(4, "little") + least[own].tobytes() + np.array([len(t) for t in mine], "<u2").tobytes() + b"".join(mine))
    return _rows({"bucket": full, "batch": [number] * len(full), "sent": sent}, SENT)


def covered(batch: Batch, answers: pa.Table, buckets: int, length: int) -> np.ndarray:
    """Whether each byte of the batch is to go."""
    _, cuts, run_key = batch.anchors(buckets)
    _, least, bucket, items = batch.texts(_answers(answers, 1, cuts, np.uint8), run_key, buckets, length)
    order, cuts = by_bucket(bucket, buckets)
    bits = np.zeros(len(least), np.uint64)
    bits[order] = _answers(answers, 2, cuts, np.uint64)
    steps = np.zeros(len(batch.data) + 1, np.int32)
    if len(items):
        text, own, first, count = items.T
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        old = np.repeat(own > least[text], count) | (np.repeat(bits[text], count) >> place.astype(np.uint64) & np.uint64(1)).astype(bool)
        window = (np.repeat(first, count) + place)[old]
        np.add.at(steps, window, 1)
        np.add.at(steps, window + length, -1)
    return np.cumsum(steps[:-1]) > 0


def cut_rows(batch: Batch, gone: np.ndarray) -> pa.Table:
    sums = np.concatenate([[0], np.cumsum(gone)])
    begins = gone & np.concatenate([[True], ~gone[:-1]]) if len(gone) else gone
    inner = batch.offsets[:-1][batch.offsets[:-1] < len(gone)]
    begins[inner] |= gone[inner]  # a run does not go on into the next document
    spans = np.concatenate([[0], np.cumsum(begins)])
    kept = [batch.data[a:b][~gone[a:b]].tobytes() for a, b in zip(batch.offsets, batch.offsets[1:])]
    return pa.table({"doc_id": batch.original, "n_bytes": pa.array(np.diff(batch.offsets), pa.int64()),
                     "n_removed": pa.array(sums[batch.offsets[1:]] - sums[batch.offsets[:-1]], pa.int64()),
                     "n_spans": pa.array(spans[batch.offsets[1:]] - spans[batch.offsets[:-1]], pa.int64()),
                     "kept": pa.array(kept, pa.binary())})


def cut_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", finish=None,
                schema: str = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary") -> DataFrame:
    """Per document its bytes, removed bytes, removed runs, and what is kept.
    ``finish`` may turn each batch's rows into others of ``schema``."""
    if length < GRAM + 8:
        raise ValueError(f"the length must be at least {GRAM + 8}")
    if length - GRAM + 1 > 64:
        raise ValueError(f"the length must be at most {GRAM + 63}: a run's windows are answered in 64 bits")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = buckets = max(LEAST_BATCHES, -(-total // BATCH_BYTES))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(batches)).alias("batch"), "doc_id", "text")

    def anchors(key, table):
        return send_anchors(key[0].as_py(), Batch.of(table, length), buckets)

    def texts(key, table, answers):
        return send_texts(key[0].as_py(), Batch.of(table, length), answers, buckets, length)

    def older(table):
        return older_windows(table, length)

    def cut(table, answers):
        batch = Batch.of(table, length)
        out = cut_rows(batch, covered(batch, answers, buckets, length))
        return finish(out) if finish else out

    by_batch = rows.groupBy("batch")
    shared = by_batch.applyInArrow(anchors, SENT_DDL).groupBy("bucket").applyInArrow(shared_anchors, ANSWER_DDL)
    windows = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(texts, SENT_DDL) \
        .groupBy("bucket").applyInArrow(older, ANSWER_DDL)
    return by_batch.cogroup(shared.union(windows).groupBy("batch")).applyInArrow(cut, schema)


def _digests(table: pa.Table) -> pa.Table:
    digests = [hashlib.sha256(x).hexdigest() for x in table.column("kept").to_pylist()]
    return table.drop_columns(["kept"]).append_column("kept_sha256", pa.array(digests, pa.string()))


def cut_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    return cut_repeats(docs, length, finish=_digests,
                       schema="doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
