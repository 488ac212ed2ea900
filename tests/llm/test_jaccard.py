import itertools
import random
import re

import numpy as np
import pytest

import quayside.llm.jaccard as jaccard
from quayside.llm.jaccard import jaccard_components, linked
from quayside.llm.components import components


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    top = {i: i for i, _ in rows if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (i, x), (j, y) in itertools.combinations(sets, 2):
        if x and y and None not in (i, j) and 100 * len(x & y) >= 80 * len(x | y):
            a, b = sorted((find(i), find(j)))
            top[b] = a
    return sorted(((i, len(x), None if i is None else i if not x and all(not y for j, y in sets if j == i) else find(i)) for i, x in sets), key=str)


def rows_of(seed, n=260):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "ÉA", "Ab", " x"]
    line = " ".join(rnd.choice(vocabulary) for _ in range(12))
    rows = []
    while len(rows) < n:
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 9, 40, 120]))]
        for _ in range(rnd.choice([1, 1, 2, 6, 25])):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 40))):
                k = rnd.randrange(len(words))
                words[k:k + rnd.choice([0, 1])] = [rnd.choice(vocabulary)]
            text = rnd.choice([" ", "\n", "  \t"]).join(words) + (f"\n{line}" if rnd.random() < 0.3 else "")
            rows.append((rnd.randrange(10**6), text.upper() if rnd.random() < 0.1 and "É" not in text else text))
    rows += [(2_000_000, None), (2_000_001, ""), (2_000_002, " \n\t"), (2_000_003, "Aa bb"), (2_000_004, "aA\x0bBB"), (2_000_005, "aa"),
             (2_000_006, "many words " * 3000), (2_000_007, "many words " * 3001), (None, "aa bb"), (None, "aa bb")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(jaccard, "TILE_NODES", 3 if seed == 1 else 4096)
    monkeypatch.setattr(jaccard, "FEW_NODES", 2)
    rows = rows_of(seed)
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n int, node string").repartition(3)
    got = jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_texts_of_one_template_that_do_not_link(spark):
    """2,000 texts at 0.70 to 0.79 of each other, and pairs among them that do link."""
    rnd = random.Random(3)
    line = [f"t{k}" for k in range(104)]
    rows = [(k, " ".join(line + [f"own{k}x{m}" for m in range(rnd.randint(14, 18))])) for k in range(2000)]
    rows += [(5000 + k, rows[k][1] + " more") for k in range(0, 2000, 100)]
    first = shingle_set(rows[0][1])
    assert 0.70 <= len(first & shingle_set(rows[1][1])) / len(first | shingle_set(rows[1][1])) <= 0.79
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == {k: k - 5000 if k >= 5000 else k for k, _ in rows}


def test_a_block_joins_its_nodes_with_few_links():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 2**62, 200).astype(np.uint64)
    sets = [np.unique(np.append(base, rnd.integers(0, 2**62, 3).astype(np.uint64))) for _ in range(300)]
    none = [frozenset()] * 300
    found = jaccard.block_links(list(range(300)), [0] * 300, sets, none, 80)
    assert len(found) == 299
    between = jaccard.block_links(list(range(300)), [k % 2 for k in range(300)], sets, none, 80)
    assert len(between) == 299 and all(a % 2 != b % 2 for a, b in between)
    assert jaccard.block_links(list(range(300)), [0] * 300, sets, [frozenset([1])] * 300, 80) == []


def test_one_id_with_several_texts_joins_them(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(5, a), (5, b), (7, a), (6, b), (6, b), (8, "c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(docs).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (7, 5), (6, 5), (8, 8)} and len(got) == 6


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_is_exact_at_the_threshold():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        pool = rnd.choice(2**62, 60, replace=False).astype(np.uint64)
        x, y = (np.sort(rnd.choice(pool, rnd.integers(1, 60), replace=False)) for _ in range(2))
        same = len(np.intersect1d(x, y))
        assert linked(x, y, 80) == (100 * same >= 80 * (len(x) + len(y) - same))


def test_components_of_paths_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(300, 400)] + [(7, 8), (8, 9), (9, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 5 for k in range(300, 400)) and got[9] == 7
