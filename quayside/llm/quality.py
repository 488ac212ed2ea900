"""Quality classifier: supervised subword embeddings.

Every word, every character n-gram of a word and every pair of neighbouring
words hashes to a learned vector; a document is the
mean of its features' vectors, and a softmax layer over that
mean gives the class probabilities. Training is stochastic gradient descent
in numpy over a bounded sample of labelled rows (``max_rows`` of each class,
taken by a hash of the id over all labels); every document is scored.

With two classes the softmax needs only the difference of the class logits,
which is linear in the mean vector. So a trained model folds to one weight
per bucket, and scoring adds the weights of a text's features and divides by
their number: the same value, without the vectors.

Defined cases: a null or empty text has no features and scores by the bias
alone; labels that are null, or both 0 and 1 for one id, teach nothing; an id
with several rows is trained on and scored row by row; without any label of
one class every score is 0.5 (nothing can be learned); an empty table gives an
empty result; other columns of both tables are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import mix, releasing, slices, with_column

BUCKETS = 1 << 16
MAX_ROWS = 2500  # training rows of each class
CACHE_WORDS = 100_000


@dataclass(frozen=True)
class Shape:
    """Of the features and of the training; all fixed by the caller."""

    buckets: int = BUCKETS
    dim: int = 16
    min_n: int = 3
    max_n: int = 4
    steps: int = 800  # updates at least; and two passes over the rows at least
    batch: int = 16
    rate: float = 2.0
    seed: int = 17


@dataclass
class Model:
    """Folded classifier: logit = bias + mean of the weights of the features."""

    weights: np.ndarray
    bias: float
    shape: Shape


def word_features(words: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of distinct words, as word number and bucket: the word
    itself and its character n-grams (of its UTF-8 bytes, with a blank at
    either end). And a hash of each word, for ``pair_buckets``."""
    data = np.frombuffer(f" {' '.join(words)} ".encode(), np.uint8)
    blank = np.flatnonzero(data == 32)
    word = np.repeat(np.arange(len(words)), np.diff(blank))  # of each place but the last; its blank comes first
    place = np.arange(len(data) - 1)
    end = blank[1:][word]
    spelt = mix(data[:-1].astype(np.uint64) | (place - blank[word]).astype(np.uint64) << np.uint64(8))
    hashes = mix(np.add.reduceat(spelt, blank[:-1]))
    numbers, buckets = [np.arange(len(words))], [hashes]
    packed = data[:-1].astype(np.uint64)
    for n in range(2, shape.max_n + 1):
        packed = packed[:len(data) - n + 1] | data[n - 1:].astype(np.uint64)[:len(packed)] << np.uint64(8 * (n - 1))
        if n >= shape.min_n:
            inside = end[:len(packed)] >= place[:len(packed)] + n - 1
            numbers.append(word[:len(packed)][inside])
            buckets.append(mix(packed[inside] + np.uint64(n << 57)))
    return np.concatenate(numbers), (np.concatenate(buckets) % np.uint64(shape.buckets)).astype(np.int64), hashes


def pair_buckets(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Buckets of the pairs of neighbours in a sequence of words, given by hash."""
    return (mix(hashes[:-1] * np.uint64(3) + hashes[1:]) % np.uint64(shape.buckets)).astype(np.int64)


def text_features(text: str | None, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    counted = Counter(words)
    number, bucket, hashes = word_features(list(counted), shape)
    place = {w: k for k, w in enumerate(counted)}
    total = np.bincount(bucket, weights=np.fromiter(counted.values(), np.float64)[number], minlength=shape.buckets)
    total += np.bincount(pair_buckets(hashes[[place[w] for w in words]], shape), minlength=shape.buckets)
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), total[ids].astype(np.int32)


def fit_vectors(rows: list[tuple[int, np.ndarray, np.ndarray]], shape: Shape) -> Model:
    """SGD over rows of (label, buckets, counts), in an order fixed by the seed."""
    rng = np.random.default_rng(shape.seed)
    vectors = (rng.random((shape.buckets, shape.dim)) - 0.5) / shape.dim
    layer, bias = np.zeros((shape.dim, 2)), np.zeros(2)
    rows = [r for r in rows if len(r[1])]
    per_class = np.bincount([r[0] for r in rows], minlength=2)
    if per_class.min() == 0:
        return Model(np.zeros(shape.buckets), 0.0, shape)
    share = [r[2] / r[2].sum() for r in rows]
    labels = np.array([r[0] for r in rows])
    epochs = max(2, math.ceil(shape.steps * shape.batch / len(rows)))
    steps, step = epochs * math.ceil(len(rows) / shape.batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), shape.batch):
            rate = shape.rate * (1 - step / steps)
            step += 1
            picked = order[at:at + shape.batch]
            mean = np.stack([share[k] @ vectors[rows[k][1]] for k in picked])
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(picked)), labels[picked]] -= 1  # the gradient of the loss
            back = p @ layer.T
            layer -= rate * mean.T @ p
            bias -= rate * p.sum(0)
            for k, g in zip(picked, back):
                vectors[rows[k][1]] -= (rate * share[k])[:, None] * g
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]), shape)


class Scorer:
    """Scores batches of texts. Keeps the summed weights of at most CACHE_WORDS
    words, or of one batch's if it has more."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}  # of a word in the three arrays
        self.sums, self.numbers, self.hashes = np.zeros(0), np.zeros(0), np.zeros(0, np.uint64)

    def score(self, texts: list[str | None]) -> list[float]:
        split = [(t or "").split() for t in texts]
        new = list(set().union(*split) - self.place.keys())
        if self.place and len(self.place) + len(new) > CACHE_WORDS:
            self._forget()
            new = list(set().union(*split))
        if new:
            number, bucket, hashes = word_features(new, self.model.shape)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.sums = np.concatenate([self.sums, np.bincount(number, weights=self.model.weights[bucket])])
            self.numbers = np.concatenate([self.numbers, np.bincount(number)])
            self.hashes = np.concatenate([self.hashes, hashes])
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, lengths.sum())
        text = np.repeat(np.arange(len(split)), lengths)
        total = np.bincount(text, weights=self.sums[words], minlength=len(split))
        count = np.bincount(text, weights=self.numbers[words], minlength=len(split))
        if len(words) > 1:
            inside = np.flatnonzero(text[1:] == text[:-1])  # pairs of words of one text
            weights = self.model.weights[pair_buckets(self.hashes[words], self.model.shape)[inside]]
            total += np.bincount(text[inside], weights=weights, minlength=len(split))
            count += np.bincount(text[inside], minlength=len(split))
        logit = self.model.bias + total / np.maximum(count, 1)
        return (1 / (1 + np.exp(-np.clip(logit, -700.0, 700.0)))).tolist()


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int, shape: Shape) -> DataFrame:
    """(label, buckets, counts) of at most ``max_rows`` ids of each class. ``learn``
    is a condition on the id. The ids are chosen before any text is read."""
    clean = labels.filter(learn & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter("quality = _most")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = None
    for value in (0, 1):
        part = clean.filter(F.col("quality") == value).orderBy(*order).limit(max_rows).select("doc_id", "quality")
        ids = part if ids is None else ids.unionByName(part)
    # bounded: two ids lists of max_rows rows
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in releasing(batches):
            found = [text_features(t, shape) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["quality"].astype("int64"),
                                "ids": [f[0].tobytes() for f in found], "counts": [f[1].tobytes() for f in found]})

    return texts.select("doc_id", "quality", "text").mapInPandas(
        features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label long, ids binary, counts binary")


def train_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = MAX_ROWS,
                  shape: Shape = Shape()) -> Model:
    """Fit on ``labels.quality``. Only the bounded sample's features reach the driver."""
    rows = training_rows(docs, labels, F.lit(True) if learn is None else learn, max_rows, shape).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.ids), bytes(r.counts)))
    return fit_vectors([(r.label, np.frombuffer(r.ids, np.int32), np.frombuffer(r.counts, np.int32)) for r in rows], shape)


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column score, the probability of class 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # one weight per bucket: 8 * BUCKETS bytes
    docs = docs.drop("score")
    schema = with_column(docs, "score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in releasing(slices(batches, text_col)):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scorer.score(texts), pa.float64())],
                                             names=[*batch.schema.names, "score"])

    return docs.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, shape: Shape = Shape()) -> DataFrame:
    """doc_id, held_out, score, predicted per document; learned from the rows not held out."""
    model = train_quality(docs, labels, ~held_out(), max_rows, shape)
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
