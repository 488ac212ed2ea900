"""Hard-negative mining by Fagin's threshold algorithm.

Scores are inner products of the whole numbers floor(scale * x). An anchor's
positives are its best rows of the same label; for each positive the best rows
of other labels are returned whose score lies between ``low`` and ``high``
percent of the positive's.

The rows are dealt into shards by ranges of (length, label, heaviest
dimension, its weight, id), so that a shard is alike and a hot label or
repeated vector is split. A shard keeps its rows sorted by every dimension.
For an anchor the lists are read side by side, from the top where the anchor's
component is positive and from the bottom where it is negative; rows met for
the first time are scored whole by random access. No row still unmet can score
more than the threshold, the sum of anchor times last value read; a search
ends when the threshold is strictly below the kth score of each of the
anchor's windows (or the window's lower end while it holds fewer), so ties are
all seen, or when every row has been met. The anchors that come to a shard read
its lists together, as many as keep ``SCORES`` scores: a row is fetched once
for all that still search, each of which has its own threshold.

Shards are visited in two rounds. The threshold before any access, from a
shard's largest and smallest value of each dimension, is known for all shards:
an anchor goes to the eligible shard with the largest one first, and then,
with the scores reached there as floors, to those whose threshold reaches
them. A shard is read once a round, and as several copies only where more than
``query_rows`` anchors come to it. The table of shard ranges is broadcast; its
size is bounded by ``SUMMARY_BYTES``, beyond which shards grow instead.

Defined cases: rows with a null id or label, a null or empty vector, or a null
or non-finite component take no part; of several rows of one id the smallest
(by vector, then label) counts; vectors of different lengths are never
compared; equal scores rank by id; an anchor without positives and a positive
without negatives give no rows; an empty table gives an empty result; other
columns are ignored. Scores are exact in 64 bits; a component or a score
beyond raises an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import staged
from quayside.llm.vectors import matrix

SHARD_ROWS = 16384
QUERY_ROWS = 8192
SUMMARY_BYTES = 64 << 20
SCORES = 1 << 22  # held at a time
FIRST_DEPTH = 8  # rows read from each list at first; doubled from round to round
LEAST, MOST = int(np.iinfo(np.int64).min), int(np.iinfo(np.int64).max)

ASK = "query long, label string, dim int, vec array<long>, key array<long>, lo array<long>, hi array<long>, floor array<long>"
FOUND = "query long, key long, id long, score long"


class SortedLists:
    """Rows of one shard and length, sorted by every dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(rows, self.order, 0)
        self.codes, names = pd.factorize(labels)
        self.names = {name: code for code, name in enumerate(names)}
        self.seen, self.depth = np.zeros(len(ids), bool), 0  # rows met and entries read of each list by the last search

    def search(self, query: int, label: str, anchor: np.ndarray, windows: list[tuple[int, int, int]], same: bool,
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`search_all` of one anchor."""
        return self.search_all([query], [label], anchor[None], [windows], same, k)[0]

    def search_all(self, queries: Sequence[int], labels: Sequence[str], anchors: np.ndarray,
                   windows: list[list[tuple[int, int, int]]], same: bool, k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per anchor and window (lowest score, highest score, score that its
        kth is known to reach) the ids and scores of its k best rows here."""
        n = len(self.ids)
        codes = [self.names.get(x, -1) for x in labels]
        least = [[max(lo, floor) for lo, _, floor in w] for w in windows]  # lowest scores that still count
        best = [[(np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)) for _ in w] for w in windows]
        self.seen[:] = False
        going, self.depth, end = np.arange(len(codes)), 0, min(FIRST_DEPTH, n)
        while len(going):
            asked = anchors[going]
            top, bottom = np.flatnonzero((asked > 0).any(0)), np.flatnonzero((asked < 0).any(0))
            met = np.full(n, not len(top) and not len(bottom))
            met[self.order[n - end:n - self.depth, top]] = True  # sorted access
            met[self.order[self.depth:end, bottom]] = True
            new = np.flatnonzero(met & ~self.seen)
            self.seen[new] = True
            threshold = np.maximum(asked, 0) @ self.values[n - end] + np.minimum(asked, 0) @ self.values[end - 1]
            got = asked @ self.rows[new].T  # random access
            for at, scores in zip(going, got):
                held = np.flatnonzero(scores >= min(least[at]))
                held = held[((self.codes[new[held]] == codes[at]) == same) & (self.ids[new[held]] != queries[at])]
                if len(held):
                    self._keep(best[at], least[at], windows[at], self.ids[new[held]], scores[held], k)
            self.depth = end
            if self.seen.all():  # no row is left that a list could show
                break
            end = min(2 * end, n)
            going = going[[bound >= min(least[at]) for at, bound in zip(going, threshold)]]
        return best

    @staticmethod
    def _keep(best, least, windows, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
        """Merge rows into the k best of each window, and raise the scores that count."""
        for w, (_, most, _) in enumerate(windows):
            inside = (scores >= least[w]) & (scores <= most)
            if inside.any():
                both = np.concatenate([best[w][0], ids[inside]]), np.concatenate([best[w][1], scores[inside]])
                order = np.lexsort((both[0], -both[1]))[:k]
                best[w] = both[0][order], both[1][order]
                if len(order) == k:
                    least[w] = max(least[w], int(best[w][1][-1]))


def _exact(rows: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as the quickest kind in which all sums of products are exact."""
    limit = int(np.abs(rows).max(initial=1)) * int(np.abs(asks).max(initial=1)) * rows.shape[1]
    kind = np.float64 if limit < 2**53 else np.int64 if limit < 2**63 else object
    return rows.astype(kind), asks.astype(kind)


def _by_label(labels: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows and of the anchors of each label that has both."""
    asked = pd.Series(np.arange(len(asking))).groupby(asking).indices
    held = pd.Series(np.arange(len(labels))).groupby(labels).indices
    return ((held[name], places) for name, places in asked.items() if name in held)


def _found(documents: pd.DataFrame, asks: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    if not len(documents) or not len(asks):
        return pd.DataFrame({"query": [], "key": [], "id": [], "score": []}, dtype="int64")
    rows, anchors = _exact(matrix(documents["vec"]), matrix(asks["vec"]))
    ids, labels, asking = documents["id"].to_numpy(), documents["label"].to_numpy(), asks["label"].to_numpy()
    queries, keys = asks["query"].to_numpy(), asks["key"].to_numpy()
    windows = [[tuple(map(int, w)) for w in zip(*x)] for x in zip(asks["lo"], asks["hi"], asks["floor"])]
    out = [(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0))]
    # rows of other labels are left out of the lists where none of them can be asked for
    for held, asked in _by_label(labels, asking) if same else [(np.arange(len(ids)), np.arange(len(asks)))]:
        lists = SortedLists(ids[held], labels[held], rows[held])
        step = max(1, SCORES // len(held))
        for some in (asked[at:at + step] for at in range(0, len(asked), step)):
            found = lists.search_all(queries[some], asking[some], anchors[some], [windows[i] for i in some], same, k)
            for i, best in zip(some, found):
                for at, (near, scores) in zip(keys[i], best):
                    out.append((np.full(len(near), queries[i]), np.full(len(near), at), near, scores))
    return pd.DataFrame({name: np.concatenate([o[c] for o in out]).astype(np.int64)
                         for c, name in enumerate(("query", "key", "id", "score"))})


def _summary(rows: DataFrame) -> pd.DataFrame:
    """Per shard and length: smallest and largest label and value of each
    dimension. One row a shard reaches the driver."""
    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (shard, dim), part in batch.groupby(["shard", "dim"]):
                w = matrix(part["vec"])
                yield pd.DataFrame({"shard": [shard], "dim": [dim], "first": [part["label"].min()], "last": [part["label"].max()],
                                    "least": [w.min(0)], "most": [w.max(0)]})

    parts = rows.select("shard", "dim", "label", "vec").mapInPandas(
        ranges, "shard int, dim int, first string, last string, least array<long>, most array<long>")

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "dim": group["dim"].iloc[:1], "first": [group["first"].min()],
                             "last": [group["last"].max()], "least": [matrix(group["least"]).min(0)],
                             "most": [matrix(group["most"]).max(0)]})

    return parts.groupBy("shard", "dim").applyInPandas(merged, parts.schema).toPandas().sort_values(["dim", "shard"])


def _round(rows: DataFrame, shards, asks: DataFrame, same: bool, k: int, first: bool, query_rows: int, name: str) -> DataFrame:
    """One round of searches. ``shards`` is the broadcast summary."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                table = shards.value[shards.value["dim"] == dim]
                w, most, least = (matrix(x).astype(float) for x in (part["vec"], table["most"], table["least"]))
                bound = np.maximum(w, 0) @ most.T + np.minimum(w, 0) @ least.T
                bound += 1 + 1e-9 * (np.abs(w) @ np.maximum(np.abs(most), np.abs(least)).T)  # rounding
                label = part["label"].to_numpy()[:, None]
                holds = (table["first"].to_numpy() <= label) & (label <= table["last"].to_numpy())
                alone = (table["first"].to_numpy() == label) & (label == table["last"].to_numpy())
                bound[~(holds if same else ~alone)] = -np.inf
                nearest = bound.argmax(1)
                if first:
                    ask, shard = np.flatnonzero(bound.max(1) > -np.inf), nearest[bound.max(1) > -np.inf]
                else:
                    bound[np.arange(len(part)), nearest] = -np.inf
                    need = np.array([min(max(a, b) for a, b in zip(*x)) for x in zip(part["lo"], part["floor"])], float)
                    ask, shard = np.nonzero((bound > -np.inf) & (bound >= need[:, None]))
                for at in range(0, len(ask), 4096):
                    yield part.iloc[ask[at:at + 4096]].assign(to_shard=table["shard"].to_numpy()[shard[at:at + 4096]])

    routed = staged(asks.mapInPandas(route, f"{ASK}, to_shard int"), f"negatives-{name}")
    copies = routed.groupBy(F.col("to_shard").alias("shard"), "dim").agg(
        F.ceil(F.count("*") / query_rows).cast("int").alias("copies"))
    # one row a shard, bounded as the summary is
    held = rows.join(F.broadcast(copies), ["shard", "dim"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    sent = routed.join(F.broadcast(copies.withColumnRenamed("shard", "to_shard")), ["to_shard", "dim"]) \
        .withColumn("to_copy", F.pmod(F.xxhash64("query"), F.col("copies")).cast("int")).withColumnRenamed("dim", "to_dim")

    def search(documents: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _found(documents, asked, same, k)

    return held.select("shard", "dim", "copy", "id", "label", "vec").groupBy("shard", "dim", "copy") \
        .cogroup(sent.groupBy("to_shard", "to_dim", "to_copy")).applyInPandas(search, FOUND)


def _search(rows: DataFrame, shards, asks: DataFrame, same: bool, k: int, query_rows: int, name: str) -> DataFrame:
    """The k best of each window over all shards, ranked from 1."""
    near = staged(_round(rows, shards, asks, same, k, True, query_rows, f"{name}-near"), f"negatives-{name}-found")
    reached = near.groupBy("query", "key").agg(F.min("score").alias("score"), F.count("*").alias("n")).filter(F.col("n") == k) \
        .groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("key", "score"))).alias("reached"))
    again = asks.join(reached, "query", "left").withColumn("floor", F.transform("key", lambda x: F.coalesce(
        F.try_element_at("reached", x), F.lit(LEAST)))).select(asks.columns)
    far = _round(rows, shards, again, same, k, False, query_rows, f"{name}-far")
    order = Window.partitionBy("query", "key").orderBy(F.col("score").desc(), "id")
    return staged(near.unionByName(far).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k),
                  f"negatives-{name}-best")


def label_rows(vectors: DataFrame, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, vec) of the valid rows, one per id, in whole numbers."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)
    one = rows.groupBy("id").agg(F.min(F.struct("vec", "label")).alias("row")).select("id", "row.*")
    held = F.forall("vec", lambda x: F.abs(x * scale) < float(2**62))
    whole = F.when(held, F.transform("vec", lambda x: F.floor(x * scale).cast("long"))).otherwise(
        F.raise_error(F.lit("a component leaves 64 bits")))
    return one.select("id", "label", F.size("vec").alias("dim"), whole.alias("vec"))


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[str], Column], positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score. ``is_anchor`` is a condition on the id column it is given;
    all rows are candidates. ``low`` and ``high`` are percentages."""
    spark = vectors.sparkSession
    plain = staged(label_rows(vectors, scale, id_col, vec_col, label_col), "negatives-plain")
    size = plain.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    shards = max(1, min(-(-size.n // shard_rows), SUMMARY_BYTES // (16 * (size.dim or 1))))
    sizes = F.transform("vec", F.abs)
    heaviest = F.array_position(sizes, F.array_max(sizes)).cast("int")
    dealt = plain.withColumn("_heavy", heaviest).withColumn("_weight", F.element_at("vec", F.col("_heavy"))) \
        .repartitionByRange(shards, "dim", "label", "_heavy", "_weight", "id")
    rows = staged(dealt.withColumn("shard", F.spark_partition_id()).drop("_heavy", "_weight"), "negatives-rows")
    summary = spark.sparkContext.broadcast(_summary(rows))

    anchors = rows.filter(is_anchor("id")).select(F.col("id").alias("query"), "label", "dim", "vec")
    bounds = [F.array("query").alias("key"), *(F.array(F.lit(x)).alias(c) for c, x in (("lo", LEAST), ("hi", MOST), ("floor", LEAST)))]
    best = _search(rows, summary, anchors.select("*", *bounds), True, positives, query_rows, "positives")
    score = "CAST(score AS DECIMAL(20, 0))"
    pairs = best.select("query", F.col("id").alias("positive"), "score",
                        F.expr(f"CAST(ceil({score} * {low} / 100) AS LONG)").alias("lo"),
                        F.expr(f"CAST(floor({score} * {high} / 100) AS LONG)").alias("hi")).filter("lo <= hi")
    windows = pairs.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("positive", "lo", "hi"))).alias("w")).select(
        "query", F.col("w.positive").alias("key"), F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"),
        F.transform("w", lambda x: F.lit(LEAST)).alias("floor"))
    found = _search(rows, summary, anchors.join(windows, "query"), False, negatives, query_rows, "negatives")
    return found.join(pairs.select("query", F.col("positive").alias("key"), F.col("score").alias("positive_score")), ["query", "key"]).select(
        F.col("query").alias("anchor_id"), F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
