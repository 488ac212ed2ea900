"""Approximate nearest neighbours by cosine: low-dimensional stable projections.

Unit vectors are projected on ``m`` Gaussian directions (2-stable: a distance
times a chi-square variable of m degrees). The projections are indexed by a
kd-tree: its upper levels, fitted on a bounded sample, deal all rows into
cells; each cell's shards build their own lower levels. A query takes its
projected neighbours in growing order, verifies their true distances, and
stops when the chi-square test holds: a point at the kth distance so far
would project nearer than the next one with probability ``confidence``.

First every query searches its own shard; then, with the distance reached
there, the shards of every other cell whose box the test does not exclude.

Parameters: ``sample_rows`` rows fit the upper levels (a sample by a hash of
the id; every row is indexed), ``cell_rows`` rows are aimed at per shard, and
a cell that the sample shows to hold more (equal vectors, say) is dealt over
several shards by a hash of the id.

Defined cases: see ``valid_vectors``; zero vectors take no part either;
vectors of different lengths are never compared; equal scores rank by id;
fewer than k candidates are all returned; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import staged
from quayside.llm.vectors import best, block_of, matrix, valid_vectors

DIRECTIONS = 8
CONFIDENCE = 0.98
SAMPLE_ROWS = 16384
CELL_ROWS = 8192
LEAF_ROWS = 64
QUERY_ROWS = 8192
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, m: int) -> float:
    """For an even m, where the distribution is a finite sum."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    low, high = 0.0, 1e3
    for _ in range(100):
        low, high = ((low + high) / 2, high) if below((low + high) / 2) < p else (low, (low + high) / 2)
    return high


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def moderate(vectors: np.ndarray) -> np.ndarray:
    """The vectors, those of extreme size scaled so that squares neither
    overflow nor vanish; a cosine does not change by that."""
    top = np.abs(vectors).max(1, keepdims=True, initial=0)
    return np.where((top < 1e-100) | (top > 1e100), vectors / np.where(top == 0, 1, top), vectors)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(1))


def cosines(rows: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """In double precision; a row's value does not depend on the other rows."""
    return (rows * query).sum(1) / (norms * norm)


@dataclass
class Split:
    """Upper levels of the kd-tree over one length of vectors."""

    axis: np.ndarray  # inner nodes in heap order; -1: none
    at: np.ndarray
    low: np.ndarray  # box of each cell
    high: np.ndarray
    shards: np.ndarray  # of each cell

    @classmethod
    def fit(cls, points: np.ndarray, rows: float, cell_rows: int) -> Split:
        """Median splits of the widest axis, for ``rows`` rows like ``points``."""
        m, depth = points.shape[1], max(0, math.ceil(math.log2(max(1.0, rows / cell_rows))))
        depth = min(depth, int(math.log2(len(points))))
        axis, at = np.full(2**depth - 1, -1), np.zeros(2**depth - 1)
        held = {0: np.arange(len(points))}
        boxes = {0: (np.full(m, -np.inf), np.full(m, np.inf))}
        for node in range(2**depth - 1):
            own = points[held[node]]
            axis[node] = int(np.argmax(np.ptp(own, axis=0))) if len(own) else 0
            at[node] = float(np.median(own[:, axis[node]])) if len(own) else 0.0
            right = points[held[node], axis[node]] > at[node]
            (low, high), low2, high2 = boxes[node], boxes[node][0].copy(), boxes[node][1].copy()
            high2[axis[node]], low2[axis[node]] = at[node], at[node]
            held[2 * node + 1], held[2 * node + 2] = held[node][~right], held[node][right]
            boxes[2 * node + 1], boxes[2 * node + 2] = (low, high2), (low2, high)
        leaves = range(2**depth - 1, 2**(depth + 1) - 1)
        per_cell = np.array([len(held[n]) for n in leaves]) * rows / max(1, len(points))
        return cls(axis, at, np.stack([boxes[n][0] for n in leaves]), np.stack([boxes[n][1] for n in leaves]),
                   np.maximum(1, np.ceil(per_cell / (2 * cell_rows))).astype(np.int64))

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(node) and node[0] < len(self.axis):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - len(self.axis)


def box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances from a point to boxes."""
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (gap * gap).sum(1)


class KdTree:
    """Lower levels over one shard: leaves with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order, starts = np.argsort(ids, kind="stable"), []

        def grow(rows: np.ndarray) -> Iterator[np.ndarray]:
            if len(rows) <= leaf_rows:
                yield rows
                return
            axis = int(np.argmax(np.ptp(points[rows], axis=0)))
            rows = rows[np.argsort(points[rows, axis], kind="stable")]
            yield from grow(rows[:len(rows) // 2])
            yield from grow(rows[len(rows) // 2:])

        leaves = list(grow(order))
        order, starts = np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])
        self.ids, self.vectors, self.points, self.starts = ids[order], moderate(vectors[order]), points[order], starts
        self.norms = lengths(self.vectors)
        self.low = np.minimum.reduceat(self.points, starts[:-1])
        self.high = np.maximum.reduceat(self.points, starts[:-1])

    def search(self, own: int, query: np.ndarray, point: np.ndarray, k: int, reach: float, quantile: float):
        """Ids and cosines of the k nearest found, none farther than ``reach``
        (a squared distance). Leaves come in order of their boxes' distances,
        a few at first and then twice as many at a time."""
        away = box_distance(self.low, self.high, point)
        leaves = np.argsort(away, kind="stable")
        norm = float(lengths(query[None, :])[0])
        ids, scores, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 4
        while at < len(leaves) and away[leaves[at]] <= quantile * reach:
            some = leaves[at:at + step]
            some = some[away[some] <= quantile * reach]
            rows = np.concatenate([np.arange(self.starts[x], self.starts[x + 1]) for x in some])
            at, step = at + step, 2 * step
            gap = self.points[rows] - point
            rows = rows[((gap * gap).sum(1) <= quantile * reach) & (self.ids[rows] != own)]
            if not len(rows):
                continue
            ids = np.concatenate([ids, self.ids[rows]])
            scores = np.concatenate([scores, cosines(self.vectors[rows], self.norms[rows], query, norm)])
            if len(ids) > k:
                worst = -np.partition(-scores, k - 1)[k - 1]
                ids, scores = ids[scores >= worst], scores[scores >= worst]
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
            if len(ids) == k:
                reach = min(reach, _distance(scores.min()))
        return ids, scores


def _distance(cosine: float) -> float:
    """Squared distance of unit vectors, with room for rounding."""
    return max(0.0, 2 - 2 * cosine) + 1e-12


def nearest(vectors: DataFrame, k: int, is_query: Callable[[str], Column], id_col: str = "vec_id",
            vec_col: str = "embedding", m: int = DIRECTIONS, confidence: float = CONFIDENCE, seed: int = 11,
            sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest found by cosine.
    ``is_query`` is a condition on the id column it is given."""
    quantile = chi_square_quantile(confidence, m)
    rows = staged(valid_vectors(vectors, id_col, vec_col).filter(F.exists("vec", lambda x: x != 0)), "ann-rows")
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query("id"), 1)).alias("q")).first()
    blocks = -(-n.q // query_rows) or 1
    # the bounded sample that fits the upper levels
    sample = rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample_rows).collect()
    splits: dict[int, Split] = {}
    for dim in {r.dim for r in sample}:
        points = unit(np.array([r.vec for r in sample if r.dim == dim])) @ directions(dim, m, seed)
        splits[dim] = Split.fit(points, n.n * len(points) / len(sample), cell_rows)
    shared = rows.sparkSession.sparkContext.broadcast(splits)  # a few hundred bytes per cell

    def project(dim: int, vecs: np.ndarray) -> np.ndarray:
        return unit(vecs) @ directions(dim, m, seed)

    def split_of(dim: int) -> Split:
        # a length that the sample has none of is rare: one cell holds it
        return shared.value.get(dim) or Split(np.zeros(0, int), np.zeros(0), np.full((1, m), -np.inf),
                                              np.full((1, m), np.inf), np.ones(1, int))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                split = split_of(dim)
                cell = split.cell(project(dim, matrix(part["vec"])))
                yield part.assign(cell=cell, shard=part["hash"].to_numpy() % split.shards[cell])

    kinds = "id long, dim int, vec array<double>, hash long, is_query boolean"
    dealt = staged(rows.select("id", "dim", "vec", F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(1 << 30)).alias("hash"),
                               is_query("id").alias("is_query"))
                   .mapInPandas(deal, f"{kinds}, cell long, shard long"), "ann-dealt")

    def look(held: pd.DataFrame, ids, vecs: np.ndarray, reach) -> pd.DataFrame:
        if not len(held) or not len(ids):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        own = matrix(held["vec"])
        dim = own.shape[1]
        tree, points = KdTree(held["id"].to_numpy(), own, project(dim, own)), project(dim, vecs)
        got = [tree.search(*x, k, r, quantile) for *x, r in zip(ids, moderate(vecs), points, reach)]
        return pd.DataFrame({"query_id": np.repeat(ids, [len(g[0]) for g in got]),
                             "vec_id": np.concatenate([g[0] for g in got]), "score": np.concatenate([g[1] for g in got])})

    def own_shard(group: pd.DataFrame) -> pd.DataFrame:
        asks = group[group["is_query"]]
        return look(group, asks["id"].to_numpy(), matrix(asks["vec"]), np.full(len(asks), np.inf))

    first = staged(dealt.groupBy("dim", "cell", "shard").applyInPandas(own_shard, FOUND), "ann-first")
    reached = first.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n")) \
        .select("query_id", F.when(F.col("n") == k, F.col("worst")).alias("worst"))
    asks = dealt.filter("is_query").join(reached, F.col("id") == F.col("query_id"), "left") \
        .select("id", "dim", "vec", "cell", "shard", "worst", block_of("id", blocks, 2).alias("block"))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ask in batch.itertuples(index=False):
                split = split_of(ask.dim)
                reach = np.inf if pd.isna(ask.worst) else _distance(ask.worst)
                point = project(ask.dim, ask.vec[None, :])[0]
                cells = np.flatnonzero(box_distance(split.low, split.high, point) <= quantile * reach)
                to = pd.DataFrame({"cell": np.repeat(cells, split.shards[cells]),
                                   "shard": np.concatenate([np.arange(split.shards[c]) for c in cells])})
                to = to[(to["cell"] != ask.cell) | (to["shard"] != ask.shard)]
                if len(to):
                    yield to.assign(id=ask.id, dim=ask.dim, vec=[ask.vec] * len(to), block=ask.block, reach=reach)[
                        ["id", "dim", "vec", "cell", "shard", "block", "reach"]]

    asked = asks.mapInPandas(visits, "id long, dim int, vec array<double>, cell long, shard long, block int, reach double")
    held = dealt.select("id", "dim", "vec", "cell", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def other_shard(documents: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return look(documents, asked["id"].to_numpy(), matrix(asked["vec"]), asked["reach"].to_numpy())

    keys = ("dim", "cell", "shard", "block")
    rest = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(other_shard, FOUND)
    return best(first.unionByName(rest), k)
