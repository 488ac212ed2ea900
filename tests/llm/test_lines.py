import os
import sys

from quayside.llm.lines import BAND, drop_boilerplate


def brute(rows, min_sites):
    sites, first = {}, {}
    for i, text, site in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" ")
            if line:
                if site is not None:
                    sites.setdefault(line, set()).add(site)
                first[line] = min(first.get(line, (i, n)), (i, n))
    out = {}
    for i, text, site in rows:
        if text is None:
            out[i] = (0, 0, None)
            continue
        lines = text.split("\n")
        gone = [n for n, x in enumerate(lines) if len(sites.get(x.strip(" "), ())) >= min_sites and first[x.strip(" ")] != (i, n)]
        out[i] = (len(lines), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return out


def run(spark, rows, min_sites):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, _lost string, n_lines int").repartition(4)
    return {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in drop_boilerplate(docs, min_sites).collect()}


def test_lines_around_the_threshold(spark):
    # lines on 0 .. 29 sites, so some lie below, in and above the band that gets exact counts
    rows = []
    for s in range(30):
        text = "\n".join([f"  on {k} sites" for k in range(30) if s < k] + [f"own {s}", "", "   "] + (["twice", "twice"] if s < 12 else []))
        rows.append((s, text, f"site{s}"))
    rows += [(100, None, "site1"), (101, "", "site2"), (102, "on 29 sites", None), (103, "on 29 sites\n" * 2000, "site3"), (104, "own 1", "site1")]
    for min_sites in (2, 10, 12):
        assert run(spark, rows, min_sites) == brute(rows, min_sites)
    assert 0 < BAND < 0.5


def test_many_sites_are_sketched(spark):
    rows = [(i, f"wide\nnarrow {i % 50}\nown {i}", f"s{i}") for i in range(3000)]
    got, want = run(spark, rows, 60), brute(rows, 60)
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert drop_boilerplate(docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = drop_boilerplate(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_against_sql(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    import duckdb
    from check_oracle import compare

    from quayside.llm.registry import ORACLE_SQLS, QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    for name in ORACLE_SQLS:
        line, ok = compare(name, spark, con, sf, QUERIES[name], ORACLE_SQLS[name])
        assert ok, line
