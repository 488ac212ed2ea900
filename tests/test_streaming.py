"""Streaming: checkpointed file streams, restart from the checkpoint, replay
of a batch, and equality with the batch forms."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quayside.operators.cdc import apply_changes
from quayside.plans.risk import risk_fact
from quayside.session import scratch_path
from quayside.sinks.tables import current_version
from quayside.streaming import read_change_stream, read_stream_state, stream_apply_changes, stream_risk

SCHEMA = "key long, seq long, op string, v string"


def _write_batch(spark, inbox, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def test_cdc_stream_restart_and_replay(spark):
    inbox, state, ckpt = (scratch_path(spark, n) for n in ("inbox", "state", "ckpt"))
    b1 = [(1, 1, "c", "a"), (2, 2, "c", "b"), (3, 3, "c", "c")]
    b2 = [(1, 4, "u", "a2"), (2, 5, "d", None), (4, 6, "r", "d")]
    b3 = [(2, 1, "u", "stale"), (3, 7, "u", "c2")]  # a late change to a deleted key
    _write_batch(spark, inbox, b1)

    def run():
        src = read_change_stream(spark, "parquet", inbox, schema=SCHEMA, max_per_trigger=1)
        stream_apply_changes(src, state, ckpt, ["key"], value_cols=["v"], layout="versioned").awaitTermination()

    run()
    _write_batch(spark, inbox, b2)
    _write_batch(spark, inbox, b3)
    run()  # restarted query picks up from its checkpoint
    got = {r.key: r.v for r in read_stream_state(spark, state).collect()}
    assert got == {1: "a2", 3: "c2", 4: "d"}
    # batch form over all changes agrees
    batch = apply_changes(None, spark.createDataFrame(b1 + b2 + b3, SCHEMA), ["key"], value_cols=["v"])
    assert got == {r.key: r.v for r in batch.collect()}
    # crash after the sink wrote but before the commit: Spark re-runs the
    # last batch id on restart, and the sink must skip it
    commits = ckpt.replace("file:", "") + "/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    version_before = current_version(spark, state)
    run()
    assert current_version(spark, state) == version_before
    assert {r.key: r.v for r in read_stream_state(spark, state).collect()} == got


def test_risk_stream_matches_batch_and_skips_deletes(spark):
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("qin", "qout", "qckpt"))
    schema = "unid long, time timestamp_ntz, lat double, lon double, mag double, seq long, op string"
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    rows = [(1, t, 20.0, 30.0, 5.0, 1, "c"), (1, t, 20.0, 30.0, 6.5, 2, "u"), (2, t, 0.0, 0.0, 3.0, 3, "c"),
            (3, t, 10.0, 10.0, 7.0, 4, "d")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(inbox)
    ports = spark.createDataFrame([(10, 20.0, 30.0), (11, 21.0, 31.0), (12, 10.0, 10.0)],
                                  "port_key long, port_latitude double, port_longitude double")
    src = read_change_stream(spark, "parquet", inbox, schema=schema)
    stream_risk(src, ports, out, ckpt, seq="seq", op="op").awaitTermination()
    got = spark.read.parquet(out).drop("run", "batch_id")
    latest = spark.createDataFrame([r for r in rows if r[5] in (2, 3)], schema)
    want = risk_fact(latest, ports)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.filter(F.col("EARTHQUAKE_KEY") == "3").count() == 0


def test_risk_stream_replace_mode_keeps_latest_scoring(spark):
    from quayside.sinks.bucketed import read_bucketed

    inbox, out, ckpt = (scratch_path(spark, n) for n in ("rin", "rout", "rckpt"))
    schema = "unid long, time timestamp_ntz, lat double, lon double, mag double"
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    ports = spark.createDataFrame([(10, 20.0, 30.0), (11, 23.0, 33.0)],
                                  "port_key long, port_latitude double, port_longitude double")
    # first scoring: magnitude 4 reaches port 10 only; re-scored at 7.5 it reaches both
    spark.createDataFrame([(1, t, 20.0, 30.0, 4.0), (2, t, 0.0, 0.0, 3.0)], schema).coalesce(1) \
        .write.mode("append").parquet(inbox)

    def run():
        src = read_change_stream(spark, "parquet", inbox, schema=schema, max_per_trigger=1)
        stream_risk(src, ports, out, ckpt, mode="replace", buckets=4).awaitTermination()

    run()
    spark.createDataFrame([(1, t, 20.0, 30.0, 7.5)], schema).coalesce(1).write.mode("append").parquet(inbox)
    run()
    got = sorted((r.EARTHQUAKE_KEY, r.PORT_KEY, r.RISK_RADIUS_KM) for r in read_bucketed(spark, out, live=False).collect())
    assert got == [("1", 10, 1000.0), ("1", 11, 1000.0), ("2", -1, -1.0)]


def test_risk_stream_writes_pairs_where_they_are_made(spark, monkeypatch):
    from quayside.operators import geojoin

    monkeypatch.setattr(geojoin, "PAIRS_PER_TASK", 50)
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("win", "wout", "wckpt"))
    schema = "unid long, time timestamp_ntz, lat double, lon double, mag double"
    rows = [(i, dt.datetime(2024, 1, 1 + i % 28), float(i % 60), float(i % 90), 7.5) for i in range(120)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(inbox)
    ports = spark.createDataFrame([(i, float(i % 50), float(i % 80)) for i in range(30)],
                                  "port_key long, port_latitude double, port_longitude double")
    stream_risk(read_change_stream(spark, "parquet", inbox, schema=schema), ports, out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    # a month's rows gathered by a shuffle would be one file
    assert got.filter("PORT_KEY <> -1").select(F.input_file_name()).distinct().count() > 5
    want = risk_fact(spark.createDataFrame(rows, schema), ports)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
