"""Exact top-k search by inner product with block-at-a-time pruning.

A vector is a document whose terms are its dimensions and whose weights are
the integers floor(scale * x). Documents are dealt into shards; a shard
orders its documents by their heaviest term and cuts them into blocks of
consecutive documents. Each block keeps its largest and smallest weight per
term. For a query the bound of a block is the sum over the terms of the
larger product; blocks are scored in falling order of their bounds, through
the block's forward index (its rows), until a bound falls below the kth score.

First every query searches its own shard; its kth score there is the starting
bound for all other shards, in blocks of queries against shards. The result
is exact: a block is left out only if all of its scores are below the kth.

Defined cases: see ``valid_vectors``; vectors of different lengths are never
compared; equal scores rank by id; fewer than k candidates are all returned;
an empty table gives an empty result. Other columns are ignored. Products
that might leave 64 bits are computed in whole numbers of any size, row by
row; an OverflowError is raised only if a score among a shard's k best leaves
64 bits, or a weight that does so itself meets one other than 0.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import staged
from quayside.llm.vectors import best, block_of, matrix, valid_vectors

SHARD_ROWS = 16384
QUERY_ROWS = 8192
BLOCK_ROWS = 256
FOUND = "query_id long, vec_id long, score long"


class BlockIndex:
    """Blocks of documents with their summed-maxima bounds."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, block_rows: int = BLOCK_ROWS):
        heaviest = weights.argmax(1)
        order = np.lexsort((ids, -weights[np.arange(len(ids)), heaviest], heaviest))
        self.ids, self.rows = ids[order], weights[order]
        self.starts = np.arange(0, len(ids), block_rows)
        self.ends = np.minimum(self.starts + block_rows, len(ids))
        self.most = np.maximum.reduceat(self.rows, self.starts)
        self.least = np.minimum.reduceat(self.rows, self.starts)
        self.largest = _largest(self.rows)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and scores that can be among its k best. ``floors``
        are scores that the kth is known to reach (or the least integer)."""
        limit = max(self.largest, 1) * max(_largest(queries), 1) * queries.shape[1]
        if limit >= 2**63:
            sizes = np.maximum(np.abs(self.most.astype(float)), np.abs(self.least.astype(float)))
            return [self._one_wide(sizes, own, q, k, floor) for own, q, floor in zip(query_ids, queries, floors)]
        kind = np.float64 if limit < 2**53 else np.int64  # both exact in their range; BLAS serves the first
        rows, queries = self.rows.astype(kind), queries.astype(kind)
        bounds = np.maximum(queries, 0) @ self.most.astype(kind).T + np.minimum(queries, 0) @ self.least.astype(kind).T
        return [self._one(rows, own, q, b, k, floor) for own, q, b, floor in zip(query_ids, queries, bounds, floors)]

    def _one(self, rows, own, query, bounds, k, floor) -> tuple[np.ndarray, np.ndarray]:
        ids, scores, kth = np.zeros(0, np.int64), np.zeros(0, np.int64), int(floor)
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] < kth:
                break
            first, end = self.starts[block], self.ends[block]
            got = rows[first:end] @ query
            keep = np.flatnonzero(got >= kth)
            keep = keep[self.ids[first:end][keep] != own]
            if len(keep):
                ids = np.concatenate([ids, self.ids[first:end][keep]])
                scores = np.concatenate([scores, got[keep].astype(np.int64)])
                if len(ids) > k:
                    top = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[top], scores[top]
                if len(ids) == k:
                    kth = max(kth, int(scores.min()))
        return ids, scores

    def _one_wide(self, sizes, own, query, k, floor) -> tuple[np.ndarray, np.ndarray]:
        """The same where a product may leave 64 bits: blocks of such rows come
        first and are never left out."""
        size = np.abs(query.astype(float))
        wide = sizes @ size >= WIDE
        bounds = np.maximum(query, 0) @ self.most.T + np.minimum(query, 0) @ self.least.T  # of wide ones not used
        found, kth = [], None if floor == LEAST else int(floor)
        for block in np.lexsort((-bounds, ~wide)):
            if not wide[block] and kth is not None and bounds[block] < kth:
                break
            ids, rows = (x[self.starts[block]:self.ends[block]] for x in (self.ids, self.rows))
            got = _wide_scores(rows, query, size) if wide[block] else (rows @ query).tolist()
            found += [(-score, i) for score, i in zip(got, ids.tolist()) if i != own and (kth is None or score >= kth)]
            found = sorted(found)[:k]
            if len(found) == k:
                kth = -found[-1][0]
        if any(not LEAST <= -score <= MOST for score, _ in found):
            raise OverflowError("an inner product exceeds 64 bits")
        return np.array([i for _, i in found], np.int64), np.array([-score for score, _ in found], np.int64)


def _largest(weights: np.ndarray) -> int:
    return max(int(weights.max(initial=0)), -int(weights.min(initial=0)))


def _wide_scores(rows: np.ndarray, query: np.ndarray, size: np.ndarray) -> list[int]:
    """Exact scores; whole numbers of any size for the rows that need them."""
    wide = np.abs(rows.astype(float)) @ size >= WIDE
    got = np.empty(len(rows), object)
    got[~wide] = (rows[~wide] @ query).tolist()
    if wide.any():
        beyond, other = (((x == MOST) | (x == LEAST)) for x in (rows[wide], query))  # Spark's floor ends there
        if (beyond & (query != 0)).any() or (other & (rows[wide] != 0)).any():
            raise OverflowError("a weight exceeds 64 bits")
        got[wide] = rows[wide].astype(object) @ query.astype(object)
    return got.tolist()


LEAST, MOST = int(np.iinfo(np.int64).min), int(np.iinfo(np.int64).max)
WIDE = 2.0**62  # sums of absolute products below it, in rounded arithmetic, are safe


def exact_top_k(vectors: DataFrame, k: int, is_query: Callable[[str], Column], scale: float = 64.0,
                id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS,
                query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best. ``is_query`` is a
    condition on the id column it is given; all rows are candidates."""
    weights = F.transform("vec", lambda x: F.floor(x * scale).cast("long"))
    rows = staged(valid_vectors(vectors, id_col, vec_col).select("id", "dim", weights.alias("vec")), "topk-rows")
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query("id"), 1)).alias("q")).first()
    shards, blocks = -(-n.n // shard_rows) or 1, -(-n.q // query_rows) or 1
    rows = rows.withColumn("shard", block_of("id", shards, 1))

    def own_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.reset_index(drop=True)
        asks = group[group["is_query"]]
        return _found(group, asks["id"].to_numpy(), matrix(asks["vec"]), np.full(len(asks), LEAST), k)

    first = staged(rows.withColumn("is_query", is_query("id")).groupBy("dim", "shard").applyInPandas(own_shard, FOUND),
                   "topk-first")
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")) \
        .select("query_id", F.when(F.col("n") == k, F.col("floor")).otherwise(F.lit(LEAST)).alias("floor"))
    asks = rows.filter(is_query("id")).join(floors, F.col("id") == F.col("query_id"), "left") \
        .select(F.col("dim").alias("to_dim"), block_of("id", blocks, 2).alias("to_block"), F.col("id").alias("query"),
                F.col("vec").alias("weights"), F.coalesce("floor", F.lit(LEAST)).alias("floor"),
                F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("shard"))).alias("to_shard"))
    held = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def other_shard(documents: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _found(documents, asked["query"].to_numpy(), matrix(asked["weights"]), asked["floor"].to_numpy(), k)

    rest = held.groupBy("dim", "shard", "block").cogroup(asks.groupBy("to_dim", "to_shard", "to_block")) \
        .applyInPandas(other_shard, FOUND)
    return best(first.unionByName(rest), k)


def _found(documents: pd.DataFrame, query_ids, queries, floors, k: int) -> pd.DataFrame:
    if not len(documents) or not len(query_ids):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    got = BlockIndex(documents["id"].to_numpy(), matrix(documents["vec"])).search(query_ids, queries, k, floors)
    return pd.DataFrame({"query_id": np.repeat(query_ids, [len(g[0]) for g in got]),
                         "vec_id": np.concatenate([g[0] for g in got]), "score": np.concatenate([g[1] for g in got])})
