import hashlib
import random
import re

from quayside.llm.mixing import Mix, mix_sources

MIX = Mix(weights={"domain": {"a": 3, "b": 1}, "lang": {"en": 2}}, budget_percent=90, max_epochs=2, seed=5)


def share(budget, children):
    """Water filling one at a time: children as {name: (capacity, weight)}."""
    out, left = {}, dict(children)
    while left:
        weight = sum(w for _, w in left.values())
        full = [n for n, (c, w) in left.items() if c * weight <= budget * w]
        if not full:
            return out | {n: w * budget // weight for n, (c, w) in left.items()}
        n = min(full, key=lambda n: (left[n][0] / left[n][1], n))
        out[n] = left[n][0]
        budget -= left.pop(n)[0]
    return out


def brute(rows, mix):
    docs = [(i, d or "", l or "", s or "", len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, l, s, d in rows]
    weight = lambda level, n: mix.weights.get(level, {}).get(n, 1)
    size = lambda *key: mix.max_epochs * sum(x[4] for x in docs if x[1:1 + len(key)] == key)
    names = lambda *key: {x[1 + len(key)] for x in docs if x[1:1 + len(key)] == key}
    copies = {}
    top = share(sum(x[4] for x in docs) * mix.budget_percent // 100, {d: (size(d), weight("domain", d)) for d in names()})
    for d, b1 in top.items():
        for l, b2 in share(b1, {l: (size(d, l), weight("lang", l)) for l in names(d)}).items():
            for s, b3 in share(b2, {s: (size(d, l, s), weight("source", s)) for s in names(d, l)}).items():
                own = [x for x in docs if x[1:4] == (d, l, s)]
                tokens = sum(x[4] for x in own)
                epochs, rest = divmod(b3, tokens) if tokens else (0, 0)
                place = lambda x: (int(hashlib.md5(f"{mix.seed}:{epochs}:{x[0]}".encode()).hexdigest()[:8], 16), x[0])  # noqa: B023,E731
                upto = 0
                for x in sorted(own, key=place):
                    upto += x[4]
                    copies[x[0]] = epochs + (epochs < mix.max_epochs and (tokens == 0 or upto <= rest))
    return copies


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, domain string, copies int, cut string")


def test_against_brute_force(spark, monkeypatch):
    import quayside.llm.mixing as mixing

    monkeypatch.setattr(mixing, "RANGE_TOKENS", 300)  # several ranges in a leaf
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])) if rnd.random() < 0.95 else None,
             rnd.choice(["en", "de", None]), "s0" if rnd.random() < 0.4 else f"s{rnd.randint(1, 4)}", rnd.choice("abc")) for i in range(400)]
    got = {r.doc_id: r.copies for r in mix_sources(table(spark, rows), MIX).collect()}
    assert got == brute(rows, MIX)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    # a/en/s1 cannot use its share; a/en/s2 takes it, and b gets no more than its weight
    rows = [(1, "w " * 10, "en", "s1", "a")] + [(i, "w " * 100, "en", "s2", "a") for i in range(2, 12)] \
        + [(i, "w " * 100, "en", "s1", "b") for i in range(20, 30)]
    mix = Mix(weights={"domain": {"a": 1, "b": 1}}, budget_percent=50, max_epochs=1)
    got = {r.doc_id: r.copies for r in mix_sources(table(spark, rows), mix).collect()}
    assert got[1] == 1 and sum(got[i] for i in range(2, 12)) == 4 and sum(got[i] for i in range(20, 30)) == 5


def test_epochs_repeat_a_small_leaf_and_empty_tables(spark):
    rows = [(1, "w " * 10, "en", "s1", "a"), (2, "w " * 1000, "en", "s2", "a"), (3, "", "de", "s3", "b")]
    mix = Mix(budget_percent=90, max_epochs=3)
    got = {r.doc_id: r.copies for r in mix_sources(table(spark, rows), mix).collect()}
    assert got[1] == 3 and got[3] == 1
    assert mix_sources(table(spark, rows).limit(0), mix).count() == 0
