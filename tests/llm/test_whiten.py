"""Whitening against numpy's own decompositions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm.registry import QUERIES
from quayside.llm.whiten import SCALE, SHIFT, leading, whiten
from tests.llm.conftest import SMALL

KIND = "vec_id long, embedding array<float>, n int, component string, x double"


def dense(a):
    """The product that ``fit`` distributes, on one matrix."""
    def product(v, beta, lefts):
        p = a @ (v - beta * lefts[:, -1] if beta else v)
        return float(p @ p), (a @ lefts).T @ p, a.T @ p
    return product


def check_leading(a, wanted):
    s, v = leading(dense(a), a.shape[1], wanted, float((a * a).sum()))
    full = np.linalg.svd(a, compute_uv=False)
    k = min(wanted, a.shape[1])
    full = np.r_[full, np.zeros(a.shape[1])][:k]
    assert len(s) >= (full > 1e-6 * full[0]).sum()
    assert np.allclose(s, full[:len(s)], rtol=0, atol=1e-12 * full[0])
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-12)
    assert np.abs(a.T @ (a @ v.T) - v.T * s**2).max() <= 1e-12 * full[0] ** 2
    return s


@pytest.mark.parametrize("seed", range(6))
def test_leading_random(seed):
    rng = np.random.default_rng(seed)
    n, d = rng.integers(5, 300), int(rng.integers(1, 120))
    check_leading(rng.standard_normal((n, d)) * rng.random(d) ** 3, 8)


def test_leading_converges_before_all_dimensions():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((900, 200)) * np.r_[np.arange(30, 18, -1), np.ones(188)]
    calls = []

    def product(*args):
        calls.append(1)
        return dense(a)(*args)
    s, _ = leading(product, 200, 8, float((a * a).sum()))
    assert np.allclose(s, np.linalg.svd(a, compute_uv=False)[:8], rtol=1e-12)
    assert len(calls) < 100


@pytest.mark.parametrize("values", [[5] * 12, [9, 9, 9, 4, 4, 4, 4, 1, 1, 1, 1, 1], [7, 7] + [0] * 10, [3] + [0] * 11, [1e3, 1, 1, 1] + [1e-2] * 8])
def test_leading_repeated_values(values):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((40, 12)))[0]
    r = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    check_leading(q * np.array(values, float) @ r.T, 8)


def test_leading_repeated_among_many():
    """A pair of equal values at the top of a space too large to be used up."""
    rng = np.random.default_rng(3)
    d = 300
    q = np.linalg.qr(rng.standard_normal((500, d)))[0]
    r = np.linalg.qr(rng.standard_normal((d, d)))[0]
    s = check_leading(q * np.r_[90, 90, 80, 70, 70, 60, 50, 40, np.linspace(9, 1, d - 8)] @ r.T, 8)
    assert np.allclose(s, [90, 90, 80, 70, 70, 60, 50, 40])


def expect(rows, k=8):
    x = np.floor(SCALE * np.array(rows, np.float32).astype(float)).astype(np.int64) + SHIFT
    n, s = len(x), x.sum(0)
    e = n * x - s
    c = e / n
    w, v = np.linalg.eigh(c.T @ c / n)
    w, v = w[::-1][:k], v[:, ::-1][:, :k]
    keep = w > 1e-12 * w[0]
    return n, (e * e).sum(1), w[keep], v[:, keep], c, np.trace(c.T @ c / n)


def check_table(out, ids, rows):
    n, deviation, w, v, c, trace = expect(rows)
    got = sorted(out.collect(), key=lambda r: (r.component, r.vec_id))
    assert len(got) == n * len(w)
    ids = np.array(ids)
    order = np.argsort(ids, kind="stable")
    for k in range(len(w)):
        part = got[k * n:(k + 1) * n]
        assert {r.component for r in part} == {k + 1} and {r.n for r in part} == {n}
        assert [r.vec_id for r in part] == ids[order].tolist()
        assert [int(r.deviation) for r in part] == deviation[order].tolist()
        want, have = (c @ v[:, k] / np.sqrt(w[k]))[order], np.array([r.whitened for r in part])
        assert min(np.abs(want - have).max(), np.abs(want + have).max()) < 1e-8
        assert all(abs(r.explained / (w[k] / trace) - 1) < 1e-10 and r.identity_error < 1e-9 for r in part)


def make(n=400, d=12, seed=4):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * np.linspace(1, 0.2, d) + rng.random(d)).astype(np.float32).tolist()


ODD = [(9000, None), (9001, []), (9002, [1.0, None] + [0.0] * 10), (9003, [float("nan")] + [0.0] * 11), (9004, [float("-inf")] + [0.0] * 11)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], KIND).repartition(3)


def test_whiten(spark):
    rows = make()
    rows += rows[:40]  # repeated vectors under other ids
    ids = list(range(len(rows)))
    out = whiten(frame(spark, list(zip(ids, rows)) + ODD))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_table(out, ids, rows)


def test_repeated_ids_null_ids_and_lengths(spark):
    a, b = make(50, 3, 1), make(40, 5, 2)
    pairs = [(k // 2, v) for k, v in enumerate(a)] + [(None, v) for v in b]
    out = whiten(frame(spark, pairs))
    assert out.filter("vec_id IS NOT NULL").count() == 50 * 3 and out.filter("vec_id IS NULL").count() == 40 * 5
    assert {r.n for r in out.filter("vec_id IS NOT NULL").select("n").distinct().collect()} == {50}


def test_without_variance(spark):
    assert whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    assert whiten(frame(spark, []).limit(0)).count() == 0
    line = whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert len(line) == 9 and {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [float(i * 10**6), 1.0]) for i in range(-500, 500)]
    got = {r.vec_id: int(r.deviation) for r in whiten(frame(spark, rows)).filter("component = 1").collect()}
    x = [i * 10**6 * SCALE + SHIFT for i in range(-500, 500)]
    assert got == {i: (1000 * (i * 10**6 * SCALE + SHIFT) - sum(x)) ** 2 for i in range(-500, 500)}
    assert max(got.values()) > 2**63


def test_query(spark):
    t = sorted(spark.read.parquet(f"{SMALL}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    out = QUERIES["op12_whitening"](spark, SMALL)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check_table(out, [r.vec_id for r in t], [r.embedding for r in t])
