"""Exact top-k and approximate neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm.ann import chi_square_quantile, nearest
from quayside.llm.topk import exact_top_k

KIND = "vec_id long, embedding array<float>, label int, score string, rank int"


def make(seed, n=700, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = [(i, (centres[i % 12] + 0.6 * rng.standard_normal(dim)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # equal vectors: ties
    return rows


ODD = [(5000, None), (5020, []), (5040, [1.0, None] + [0.0] * 14), (5060, [float("nan")] + [0.0] * 15), (5080, [float("inf")] + [0.0] * 15),
       (None, [1.0] * 16)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], KIND).repartition(3)


def brute_top(rows, k, every):
    ids = np.array([i for i, _ in rows])
    w = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        s, other = w @ w[q], ids != ids[q]
        for rank, j in enumerate(np.lexsort((ids[other], -s[other]))[:k], 1):
            out.append((ids[q], rank, ids[other][j], s[other][j]))
    return sorted(out)


def test_exact_top_k(spark):
    rows = make(1)
    for shard_rows, query_rows in ((16384, 8192), (100, 10)):
        got = exact_top_k(frame(spark, rows + ODD), 20, lambda i: F.col(i) % 20 == 0, shard_rows=shard_rows, query_rows=query_rows)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(rows, 20, 20)


def test_few_candidates_lengths_repeats_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [1.0]), (21, [-1.0]), (0, [1.0, 2.0]), (40, [0.0, 0.0])]
    got = exact_top_k(frame(spark, rows), 20, lambda i: F.col(i) % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 64 * 32 + 128 * 32), (0, 2, 40, 0), (20, 1, 21, -4096), (40, 1, 0, 0), (40, 2, 1, 0)]
    assert exact_top_k(frame(spark, rows).limit(0), 20, lambda i: F.col(i) % 20 == 0).count() == 0
    big = [(0, [1e9, 1.0]), (1, [1e9, 2.0])]
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(frame(spark, big), 5, lambda i: F.col(i) % 20 == 0).collect()


def test_wide_products(spark):
    """Large components whose inner products stay in 64 bits, or leave it on the way only."""
    rows = make(3, 200)
    rows += [(2000, [6e7] + [0.0] * 15), (2001, [0.0, 6e7] + [0.0] * 14), (2002, [3.0, 6e7] + [0.0] * 14),
             (2020, [0.0, 0.0, 2e8, 2e8] + [0.0] * 12), (2021, [0.0, 0.0, 2e8, -2e8] + [0.0] * 12), (2022, [0.0, 0.0, 1.0, 2.0] + [0.0] * 12)]
    weights = {i: [math.floor(64 * x) for x in np.array(v, np.float32).tolist()] for i, v in rows}
    want = []
    for q in (i for i in weights if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(weights[q], w)), i) for i, w in weights.items() if i != q)[:20]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    for shard_rows in (16384, 50):
        got = exact_top_k(frame(spark, rows + ODD), 20, lambda i: F.col(i) % 20 == 0, shard_rows=shard_rows, query_rows=10)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


def test_weights_and_scores_beyond_64_bits(spark):
    far = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1e300, 2.0]), (2, [5.0, 1.0])], "vec_id long, embedding array<double>")
    got = exact_top_k(far, 5, lambda i: F.col(i) % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 64 * 128), (0, 2, 2, 64 * 64)]
    for asked in ([1.0, 0.0], [-1.0, 0.0]):
        bad = spark.createDataFrame([(0, asked), (1, [1e300, 2.0])], far.schema)
        with pytest.raises(Exception, match="64 bits"):
            exact_top_k(bad, 5, lambda i: F.col(i) % 20 == 0).collect()


def brute_near(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s, other = u @ u[q], ids != ids[q]
        order = np.lexsort((ids[other], -np.round(s[other], 12)))[:k]
        out[int(ids[q])] = [(int(ids[other][j]), float(s[other][j])) for j in order]
    return out


def test_neighbours(spark):
    rows = make(2)
    want = brute_near(rows, 5, 10)
    for cells in (8192, 60):
        found = nearest(frame(spark, rows + ODD + [(7000, [0.0] * 16)]), 5, lambda i: F.col(i) % 10 == 0, cell_rows=cells, query_rows=40).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.95 * 5 * len(want)
        exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
        for q, found in got.items():
            for i, s in found:
                assert math.isclose(s, exact[q] @ exact[i] / np.linalg.norm(exact[q]) / np.linalg.norm(exact[i]), abs_tol=1e-12)
        assert [i for i, _ in got[1000]] == [7, 1001, 1002, 1003, 1004]  # equal vectors, by id


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = brute_near(rows, 5, 50), {}
    for r in nearest(table, 5, lambda i: F.col(i) % 50 == 0, cell_rows=100).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * 5 * len(want)


def test_neighbour_edge_cases(spark):
    rows = [(0, [1e-200, 0.0]), (1, [1e200, 1e200]), (50, [3.0]), (2, [0.0, -1.0])]
    frame64 = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, round(r.score, 9)) for r in nearest(frame64, 5, lambda i: F.col(i) % 50 == 0).collect()}
    assert got == {(0, 1): (1, round(0.5 ** 0.5, 9)), (0, 2): (2, 0.0)}
    assert nearest(frame64.limit(0), 5, lambda i: F.col(i) % 50 == 0).count() == 0


def test_chi_square_quantile():
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3 and abs(chi_square_quantile(0.5, 2) - 1.3863) < 1e-4
