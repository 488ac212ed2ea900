"""Fingerprints, bitmap rollups and CSV records with quoted line breaks."""

import random

from pyspark.sql import functions as F

from quayside.operators.bitmaps import bitmap_rollup, distinct_in, id_numbers
from quayside.operators.fingerprint import compare_content, fingerprint, merge_fingerprints
from quayside.session import scratch_path
from quayside.sources.files import file_lines, file_starts, read_csv_by_name

KIND = "p int, a long, b string, c double"


def rows(seed, n=300):
    rnd = random.Random(seed)
    return [(rnd.choice([1, 2, 3, None]), rnd.randint(0, 5), rnd.choice(["x", "y", None, ""]), rnd.choice([0.0, -0.0, 1.5, None, float("nan")]))
            for _ in range(n)]


def test_fingerprint_ignores_order_and_merges(spark):
    data = rows(1)
    one = spark.createDataFrame(data, KIND)
    other = spark.createDataFrame(data[::-1], KIND).repartition(5).select("c", "b", "a", "p")
    assert sorted(map(str, fingerprint(one, ["p"]).collect())) == sorted(map(str, fingerprint(other, ["p"]).collect()))
    whole = fingerprint(one, [], ["a", "b", "c"]).collect()
    assert merge_fingerprints(fingerprint(one, ["p"]), []).collect() == whole
    plan = fingerprint(one, ["p"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(p") == 1 and "partial_sum" in plan  # only sums of a group are shuffled


def test_fingerprint_sees_small_changes(spark):
    base = [(1, 1, "x", 1.0), (1, 2, "y", 2.0)]
    for changed in ([(1, 2, "x", 1.0), (1, 1, "y", 2.0)],        # values swapped between rows
                    [(1, 1, "x", 1.0), (1, 2, None, 2.0)], [(1, 1, "x", 1.0), (1, 2, "", 2.0)],
                    [(1, 1, "x", 1.0), (1, 1, "x", 1.0)], [(1, 1, "x", None), (1, 2, "y", 2.0)]):
        got = compare_content(spark.createDataFrame(base, KIND), spark.createDataFrame(changed, KIND), ["p"]).collect()
        assert [r.status for r in got] == ["CONTENT"], changed
    same = compare_content(spark.createDataFrame(base, KIND), spark.createDataFrame(base[::-1], KIND), ["p"]).collect()
    assert [tuple(r) for r in same] == [(1, 2, 2, "OK")]


def test_compare_content_statuses(spark):
    a = spark.createDataFrame([(1, 1, "x", 1.0), (2, 1, "x", 1.0), (3, 1, "x", 1.0), (None, 1, "x", 1.0)], KIND)
    b = spark.createDataFrame([(1, 1, "x", 1.0), (3, 1, "x", 1.0), (3, 1, "x", 1.0), (4, 1, "x", 1.0), (None, 1, "x", 9.0)], KIND)
    got = {r.p: r.status for r in compare_content(a, b, ["p"]).collect()}
    assert got == {1: "OK", 2: "MISSING", 3: "ROWS", 4: "EXTRA", None: "CONTENT"}


def test_rollup_equals_distinct_counts(spark):
    """More ids than a bucket holds, repeated and NULL ids, flags that are NULL; a later day with new ids."""
    df = spark.range(120_000).select((F.col("id") * 7919 % 70_001).alias("u"), (F.col("id") % 4).alias("day"), (F.col("id") % 3).alias("s"),
                                     F.when(F.col("id") % 5 > 0, F.col("id") % 5 == 1).alias("hit"))
    df = df.unionByName(spark.createDataFrame([(None, 0, 0, True)], "u long, day long, s long, hit boolean"))
    first = df.filter("day < 3")
    numbers = id_numbers(first, "u")
    later = id_numbers(df.filter("day = 3").unionByName(spark.createDataFrame([(999_999, 3, 1, True)], df.schema)), "u", numbers)
    assert later.count() == later.select("number").distinct().count() == later.agg(F.max("number")).first()[0]
    everything = df.unionByName(spark.createDataFrame([(999_999, 3, 1, True)], df.schema))
    flags = {"hits": F.col("hit")}
    rollup = bitmap_rollup(first, numbers, "u", ["day", "s"], flags) \
        .unionByName(bitmap_rollup(everything.filter("day = 3"), later, "u", ["day", "s"], flags))
    exact = [F.countDistinct("u").alias("ids"), F.countDistinct(F.when(F.col("hit"), F.col("u"))).alias("hits")]
    for by in ([], ["s"], ["day", "s"]):
        want = everything.groupBy(*by).agg(*exact) if by else everything.agg(*exact)
        assert sorted(map(tuple, distinct_in(rollup, by, ["ids", "hits"]).collect())) == sorted(map(tuple, want.collect()))
    assert tuple(distinct_in(rollup.filter("day = 9"), [], ["ids", "hits"]).first()) == (0, 0)


def test_csv_records_keep_their_breaks(spark):
    src = scratch_path(spark, "csv")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = {"a b.csv": 'k,note\n1,"x, ""y""\nz"\nk,note\n\n2, plain \n', "c.csv": "note,k,more\nn3,3,\n", "empty.csv": "", "head.csv": "k,note\n"}
    for name, text in files.items():
        path = hadoop.Path(f"{src}/{name}")
        out = path.getFileSystem(conf).create(path)
        out.write(bytearray(text.encode()))
        out.close()
    got = sorted(((r.k, r.note, r.more) for r in read_csv_by_name(spark, src).collect()), key=str)
    assert got == [("1", 'x, "y"\nz', None), ("2", " plain ", None), ("3", "n3", None), ("k", "note", None)]


def test_headers_are_found_without_a_sort(spark, tmp_path):
    """Of every file the first line, whatever the blocks of a task; nothing
    but a number a file is aggregated, so no task sorts or holds the lines."""
    for i in range(12):
        (tmp_path / f"f{i}.csv").write_text(("b,a\n" if i % 3 else "a,b\n") + f"{i},x\n" * (1 + 40 * i))
    lines = file_lines(spark, str(tmp_path))
    plan = file_starts(lines)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    got = read_csv_by_name(spark, str(tmp_path)).groupBy("_source_path").agg(F.count("*").alias("n"), F.max("a").alias("a"), F.max("b").alias("b"))
    want = {(f"f{i}.csv", 1 + 40 * i, *(("x", str(i)) if i % 3 else (str(i), "x"))) for i in range(12)}
    assert {(r[0].rsplit("/", 1)[1], r.n, r.a, r.b) for r in got.collect()} == want
