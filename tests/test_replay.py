"""Offsets, limits, restarts and data loss of the replayed topic."""

import json

import pytest
from pyspark.sql import functions as F

from quayside.session import scratch_path
from quayside.sources.replay import OffsetsLost, ReplayReader, append_to_topic


def topic_of(spark, n=100, segment_rows=10):
    path = scratch_path(spark, "topic")
    append_to_topic(spark.range(n), path, F.when(F.col("id") % 4 == 0, 1).otherwise(0), F.col("id").cast("string"), ["id"], segment_rows=segment_rows)
    return path


def read(reader, start, end):
    return sorted((p, o, v) for s in reader.partitions(start, end) for b in reader.read(s) for p, o, v in zip(*b.to_pydict().values()))


def test_offsets_and_limits(spark):
    path = topic_of(spark)
    reader = ReplayReader({"path": path, "maxOffsetsPerTrigger": "30"})
    assert reader.initialOffset() == {"0": 0, "1": 0}
    assert ReplayReader({"path": path, "startingOffsets": "latest"}).initialOffset() == {"0": 75, "1": 25}
    ends = [reader.latestOffset() for _ in range(6)]
    assert [sum(e.values()) for e in ends] == [30, 60, 90, 100, 100, 100] and ends[-1] == {"0": 75, "1": 25}
    got = []
    for start, end in zip([{}] + ends, ends):
        got += read(reader, start, end)
    assert sorted(got) == sorted([(1 if i % 4 == 0 else 0, i // 4 if i % 4 == 0 else i - i // 4 - 1, str(i)) for i in range(100)])
    assert reader.partitions(ends[-1], ends[-1]) == []
    assert len(reader.partitions({"0": 5}, {"0": 75})) == 8  # a task for each segment of 10


def test_appending_goes_on(spark):
    path = topic_of(spark, 40)
    append_to_topic(spark.range(40, 60), path, F.lit(0), F.col("id").cast("string"), ["id"], {0: 30, 1: 10}, segment_rows=10)
    reader = ReplayReader({"path": path})
    assert reader.latestOffset() == {"0": 50, "1": 10}
    assert [(o, v) for _, o, v in read(reader, {"0": 29}, {"0": 33})] == [(29, "39"), (30, "40"), (31, "41"), (32, "42")]


def test_data_loss(spark):
    path = topic_of(spark)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = hadoop.Path(f"{path}/partition=0/segment=0")
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    with pytest.raises(OffsetsLost, match="partition 0"):
        ReplayReader({"path": path}).partitions({"0": 5}, {"0": 20})
    reader = ReplayReader({"path": path, "failOnDataLoss": "false"})
    assert [o for _, o, _ in read(reader, {"0": 5}, {"0": 12})] == [10, 11]
    assert ReplayReader({"path": path}).initialOffset()["0"] == 10


def test_restart_reads_the_querys_own_log(spark):
    path, checkpoint = topic_of(spark), scratch_path(spark, "checkpoint")
    log = "\n".join(["v1", json.dumps({"batchWatermarkMs": 0}), json.dumps({"0": 40, "1": 7})])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for n, text in ((2, "v1\n{}\n{}"), (10, log)):
        file = hadoop.Path(f"{checkpoint}/offsets/{n}")
        out = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file)
        out.write(bytearray(text.encode()))
        out.close()
    reader = ReplayReader({"path": path, "maxOffsetsPerTrigger": "10", "checkpoint": checkpoint})
    assert reader.latestOffset() == {"0": 45, "1": 12}
