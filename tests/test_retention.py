"""Retention by partition: folders go whole, one is rewritten, the others keep their files."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from quayside.operators.snapshot import apply_retention
from quayside.sinks.tables import expire_partitions, partition_values

START = dt.datetime(2024, 3, 1)
KIND = "id long, at timestamp_ntz"


def write(spark, path, rows):
    df = spark.createDataFrame(rows, KIND)
    df.withColumn("day", F.to_date("at")).write.partitionBy("day").parquet(path)
    return df


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_only_the_edge_is_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    df = write(spark, path, [(k, START + dt.timedelta(hours=k)) for k in range(24 * 6)] + [(900, None), (901, None)])
    before, as_of = files(path), dt.datetime(2024, 3, 6, 7)
    done = expire_partitions(spark, path, "at", as_of - dt.timedelta(days=2))
    assert done == {"removed": ["2024-03-01", "2024-03-02", "2024-03-03"], "rewritten": ["2024-03-04"]}
    assert ids(spark.read.parquet(path)) == ids(apply_retention(df, "at", "2 days", as_of))
    after = files(path)
    later = {f: t for f, t in before.items() if "day=2024-03-05" in f or "day=2024-03-06" in f or "HIVE_DEFAULT" in f}
    assert later and {f: after.get(f) for f in later} == later
    assert expire_partitions(spark, path, "at", as_of - dt.timedelta(days=2)) == {"removed": [], "rewritten": []}
    assert files(path) == after  # a repeated run touches nothing


def test_edges(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, [(1, START), (2, START + dt.timedelta(hours=5)), (3, START + dt.timedelta(days=1))])
    before = files(path)
    assert expire_partitions(spark, path, "at", START) == {"removed": [], "rewritten": []}  # midnight: nothing to cut
    assert files(path) == before
    assert expire_partitions(spark, path, "at", START + dt.timedelta(hours=5)) == {"removed": [], "rewritten": ["2024-03-01"]}
    assert ids(spark.read.parquet(path)) == [2, 3]  # the cut-off itself stays
    assert expire_partitions(spark, path, "at", START + dt.timedelta(hours=6)) == {"removed": ["2024-03-01"], "rewritten": []}
    assert ids(spark.read.parquet(path)) == [3] and partition_values(spark, path, "day") == ["2024-03-02"]
    assert expire_partitions(spark, str(tmp_path / "none"), "at", START) == {"removed": [], "rewritten": []}
