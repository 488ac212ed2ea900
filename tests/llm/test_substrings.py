import hashlib
import random

import numpy as np
import pytest

import quayside.llm.substrings as substrings
from quayside.llm.substrings import IndexFamily, cut_digests, cut_repeats


def brute(rows, length=50):
    starts = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            starts[w] = min(starts.get(w, float("inf")), float("inf") if i is None else i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if starts[data[p:p + length]] < (float("inf") if i is None else i):
                gone[p:p + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    passages = [word(rnd.randint(45, 160)) for _ in range(8)]
    rows = [(i, "".join(rnd.choice([word(rnd.randint(0, 40)), rnd.choice(passages), rnd.choice(passages)[3:80]]) for _ in range(rnd.randint(0, 8))))
            for i in rnd.sample(range(10_000), 120)]
    rows += [(20_000, None), (20_001, ""), (20_002, "x" * 49), (20_003, "x" * 50), (20_004, "x" * 4000), (20_005, "\0" * 60), (20_006, "\0" * 61),
             (None, passages[0]), (None, passages[0]), (5, passages[1]), (5, passages[1]), (20_010, "ab" * 300), (20_011, "ba" * 200)]
    return rows


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[4]))


@pytest.mark.parametrize("hot", [50_000, 2])
def test_against_brute_force(spark, monkeypatch, hot):
    import quayside.llm.substrings as module

    monkeypatch.setattr(module, "LEAST_BATCHES", 4)
    rows = rows_of(hot)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, batch int").repartition(3)
    assert order(cut_digests(docs).collect()) == order(brute(rows))


def test_hot_anchors_by_windows():
    """The step functions with every shared anchor taken as hot."""
    import pyarrow as pa

    rows = [r for r in rows_of(7) if r[0] is not None]
    was, substrings.HOT_TEXTS = substrings.HOT_TEXTS, 0
    try:
        tables = [pa.table({"doc_id": pa.array([r[0] for r in part], pa.int64()), "text": pa.array([r[1] or "" for r in part])})
                  for part in (rows[::2], rows[1::2])]
        batches = [substrings.Batch.of(t, 50) for t in tables]
        buckets = 3

        def deal(sent, answer):
            both = pa.concat_tables(sent)
            return pa.concat_tables([answer(both.filter(pa.compute.equal(both["bucket"], b))) for b in sorted(set(both["bucket"].to_pylist()))])

        first = deal([substrings.send_anchors(k, b, buckets) for k, b in enumerate(batches)], substrings.shared_anchors)
        own = lambda t, k: t.filter(pa.compute.equal(t["batch"], k))
        second = deal([substrings.send_texts(k, b, own(first, k), buckets, 50) for k, b in enumerate(batches)],
                      lambda t: substrings.older_windows(t, 50))
        answers = pa.concat_tables([first, second])
        got = [r for k, b in enumerate(batches) for r in
               substrings._digests(substrings.cut_rows(b, substrings.covered(b, own(answers, k), buckets, 50))).to_pylist()]
        assert order(tuple(r.values()) for r in got) == order(brute(rows))
    finally:
        substrings.HOT_TEXTS = was


def test_index_family_levels_grow_geometrically():
    family, rnd = IndexFamily(), np.random.default_rng(1)
    seen = {}
    for portion in range(40):
        windows = rnd.integers(0, 3000, 200).astype("S8")
        ids = np.full(200, portion)
        least = family.add(windows, ids)
        for w in windows.tolist():
            seen.setdefault(w, portion)
        assert least.tolist() == [seen[w] for w in windows.tolist()]
    sizes = [len(x[0]) for x in family.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(seen)


def test_other_lengths_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abcdefghij" * 10), (2, "abcdefghij" * 10)], "doc_id long, text string")
    assert [r.n_removed for r in cut_repeats(docs, 30).orderBy("doc_id").collect()] == [0, 100]
    assert cut_digests(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        cut_repeats(docs, 10)
