"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm.negatives import LEAST, MOST, SortedLists, hard_negatives
from quayside.llm.registry import QUERIES
from tests.llm.conftest import SMALL

KIND = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95, scale=256):
    """Straight from the definition, in Python integers."""
    held = {}
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
        if ok and (i not in held or (v, label) < held[i]):
            held[i] = (v, label)
    w = {i: ([int(np.floor(scale * float(np.float32(x)))) for x in v], label) for i, (v, label) in held.items()}
    out = []
    for a in sorted(w):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(w[a][0], v)), i, label) for i, (v, label) in w.items()
                  if i != a and len(v) == len(w[a][0])]
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2] == w[a][1]][:positives]:
            fit = [s for s in scored if s[2] != w[a][1] and low * -ps <= 100 * -s[0] <= high * -ps]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 0.5, 3) for i, v, label in rows], KIND).repartition(3)


def mined(df, **options):
    out = hard_negatives(df, lambda i: F.col(i) % 50 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def make(seed, n=900, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, dim))
    rows = [(i, (centres[i % 9] + 0.7 * rng.standard_normal(dim)).astype(np.float32).tolist(), int(rng.integers(labels)))
            for i in range(n)]
    rows += [(2000 + i, rows[5][1], i % 2) for i in range(120)]  # one vector many times: ties
    return rows


ODD = [(5000, None, 1), (5050, [], 1), (5100, [1.0, None] + [0.0] * 10, 1), (5150, [float("nan")] + [0.0] * 11, 1),
       (5200, [float("inf")] + [0.0] * 11, 1), (None, [1.0] * 12, 1), (5250, [1.0] * 12, None)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 60, "query_rows": 4}])
def test_equals_brute_force(spark, options):
    rows = make(1)
    got = mined(frame(spark, rows + ODD), **options)
    assert len(got) > 100 and got == brute(rows)


def test_other_windows(spark):
    rows = make(2, n=400)
    options = {"positives": 2, "negatives": 7, "low": 10, "high": 60}
    assert mined(frame(spark, rows), shard_rows=100, **options) == brute(rows, **options)


def test_edge_cases(spark):
    zero = [(i, [0.0, 0.0], i // 10 % 2) for i in range(0, 60, 10)]  # zero anchors: all scores are 0
    assert mined(frame(spark, zero)) == brute(zero) != []
    alone = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 2), (50, [1.0], 1), (51, [1.0], 1), (52, [0.9], 2), (100, [-1.0, 0.5], 7)]
    assert mined(frame(spark, alone)) == brute(alone)
    negative = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.8, 0.0], 2), (3, [0.5, 0.0], 2)]  # a positive below 0 has no window
    assert mined(frame(spark, negative)) == brute(negative) == []
    same = [(i, [0.5, 0.5], 3) for i in range(60)]
    assert mined(frame(spark, same)) == []
    assert mined(frame(spark, zero).limit(0)) == []
    repeated = [(0, [1.0, 1.0], 1), (0, [1.0, 0.5], 1), (7, [1.0, 1.0], 1), (8, [0.7, 0.7], 2), (8, [0.8, 0.7], 2), (8, [0.7, 0.7], 2)]
    assert mined(frame(spark, repeated)) == brute(repeated) != []


def test_large_numbers(spark):
    """Products beyond 53 and 63 bits on the way, scores within 64."""
    for size in (3e5, 2e6):
        rows = [(i, [float(np.float32(size * (1 + i % 7))), float(np.float32(size * (i % 5 - 2)))], i % 3) for i in range(80)]
        assert mined(frame(spark, rows)) == brute(rows) != []
    with pytest.raises(Exception, match="64 bits"):
        mined(frame(spark, [(0, [1e30], 1), (1, [1e30], 1)]))


def test_search_stops_early():
    """On rows that follow one direction few are scored, and none is lost."""
    rng = np.random.default_rng(3)
    rows = np.floor(1000 * (rng.standard_normal((5000, 1)) * np.ones(6) + 0.05 * rng.standard_normal((5000, 6))))
    lists = SortedLists(np.arange(5000), np.array(["a", "b"], object)[np.arange(5000) % 2], rows)
    anchor = np.array([5.0, 4, 3, 2, 1, 0])
    (ids, scores), = lists.search(-1, "a", anchor, [(LEAST, MOST, LEAST)], True, 5)
    own = np.flatnonzero(lists.labels == "a")
    want = own[np.lexsort((own, -(rows[own] @ anchor)))[:5]]
    assert ids.tolist() == want.tolist() and scores.tolist() == (rows[want] @ anchor).tolist()
    assert lists.seen.sum() < 500


def test_ties_at_the_threshold():
    """Rows that tie with the kth score are met before the search ends."""
    rows = np.ones((400, 3))
    lists = SortedLists(np.arange(400)[::-1].copy(), np.full(400, "b", object), rows)
    (ids, _), = lists.search(-1, "a", np.array([1.0, 1, 1]), [(0, 10, LEAST)], False, 3)
    assert ids.tolist() == [0, 1, 2]


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, SMALL).collect())) == brute(rows)


@pytest.mark.parametrize("same", [True, False])
def test_anchors_read_the_lists_together(same):
    """All anchors of a shard in one pass give what each gives alone, and the
    lists are left once every row has been met: unclustered vectors of 64
    dimensions are all met long before the lists end."""
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.standard_normal((4096, 64)))
    rows[50:90] = rows[49]  # ties
    lists = SortedLists(np.arange(4096), np.array(["a", "b", "c"], object)[np.arange(4096) % 3], rows)
    anchors = np.concatenate([rows[40:56], np.zeros((1, 64)), rng.integers(-300, 300, (3, 64))])
    queries, labels = [*range(40, 56), -1, -1, -1, -1], [*lists.labels[40:56], "a", "z", "b", "c"]
    windows = [[(LEAST, MOST, LEAST)], [(0, 10**6, LEAST), (-10**5, 10**5, 0)]] * 10
    found = lists.search_all(queries, labels, anchors, windows, same, 5)
    assert lists.seen.all() and lists.depth < 1024
    for query, label, anchor, window, got in zip(queries, labels, anchors, windows, found):
        scores = rows @ anchor
        for (lo, hi, floor), (ids, best) in zip(window, got):
            fit = np.flatnonzero(((lists.labels == label) == same) & (lists.ids != query) & (scores >= max(lo, floor)) & (scores <= hi))
            want = fit[np.lexsort((fit, -scores[fit]))[:5]]
            assert ids.tolist() == want.tolist() and best.tolist() == scores[want].tolist()
