"""Streaming workloads (T1-T5, T2 over S4/S5, T3).

The inputs are files that Spark writes from the driver's tables into the
shared checkpoint folder (several files, so the stream sees several
micro-batches); the queries drain them with ``availableNow`` and return the
resulting table. Their oracles are those of the batch forms.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import ensure_utc, scratch_path
from quayside.sources.messages import JSON_TIME_OPTIONS, decode_json
from quayside.streaming import read_change_stream, run_stream, read_stream_state, stream_apply_changes, stream_risk
from quayside.workloads import ORACLE_SQL, register
from quayside.workloads import w_keys_cdc, w_risk  # noqa: F401  (oracles reused below)
from quayside.workloads.fixtures import changes, ports, quakes, table

CHANGE_MESSAGE = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("event_type", T.StringType()),
])


def _cdc_stream(spark, sf_dir, layout: str, buckets: int = 8):
    ensure_utc(spark)
    inbox = scratch_path(spark, "cdc-inbox")
    msgs = changes(spark, sf_dir).select(
        F.to_json(F.struct(*CHANGE_MESSAGE.fieldNames()), JSON_TIME_OPTIONS).alias("value"))
    # six files in sequence order: six micro-batches at one file per trigger
    msgs.repartitionByRange(6, "value").write.text(inbox)
    raw = read_change_stream(spark, "text", inbox, max_per_trigger=1)
    decoded = decode_json(raw, CHANGE_MESSAGE).filter(~F.col("_malformed")).drop("_malformed")
    state = scratch_path(spark, "cdc-state")
    q = stream_apply_changes(decoded, state, scratch_path(spark, "cdc-ckpt"), ["key"],
                             value_cols=["ts", "value", "event_type"], layout=layout, buckets=buckets)
    q.awaitTermination()
    return read_stream_state(spark, state).select("key", "ts", "value", "event_type", "seq")


def risk_stream(spark, sf_dir):
    ensure_utc(spark)
    inbox = scratch_path(spark, "quake-inbox")
    q = quakes(spark, sf_dir).select("unid", "time", "lat", "lon", "mag")
    q.repartitionByRange(5, "unid").write.parquet(inbox)
    stream = read_change_stream(spark, "parquet", inbox, schema=q.schema, max_per_trigger=1)
    fact_path = scratch_path(spark, "risk-fact")
    query = stream_risk(stream, ports(spark, sf_dir), fact_path, scratch_path(spark, "risk-ckpt"),
                        risk_options={"reason_format": "rounded", "round_digits": 6})
    query.awaitTermination()
    return spark.read.parquet(fact_path).drop("batch_id").select(
        "EARTHQUAKE_KEY", "PORT_KEY", "EARTHQUAKE_DATE_KEY", "DISTANCE_KM", "RISK_RADIUS_KM", "IS_NEARBY",
        "RISK_LEVEL", "RISK_REASON", "EVENT_YEAR", "EVENT_MONTH")


def cdc_stream(spark, sf_dir):
    """State published as a new version per micro-batch."""
    return _cdc_stream(spark, sf_dir, "versioned")


def cdc_stream_bucketed(spark, sf_dir):
    """State bucketed by key hash; each micro-batch rewrites only the buckets
    it touches (the layout for large state tables)."""
    return _cdc_stream(spark, sf_dir, "bucketed", buckets=8)


def cdc_stream_reset(spark, sf_dir):
    """The second half of the messages comes under a new checkpoint, whose
    batch ids start at 0 again, over the state of the first."""
    ensure_utc(spark)
    state = scratch_path(spark, "cdc-state")
    ch = changes(spark, sf_dir).select(F.to_json(F.struct(*CHANGE_MESSAGE.fieldNames()), JSON_TIME_OPTIONS).alias("value"), "seq")
    for half in (0, 1):
        inbox = scratch_path(spark, f"cdc-inbox-{half}")
        ch.filter(F.col("seq") % 2 == half).repartitionByRange(3, "seq").select("value").write.text(inbox)
        raw = read_change_stream(spark, "text", inbox, max_per_trigger=1)
        decoded = decode_json(raw, CHANGE_MESSAGE).filter(~F.col("_malformed")).drop("_malformed")
        stream_apply_changes(decoded, state, scratch_path(spark, "cdc-ckpt"), ["key"], value_cols=["ts", "value", "event_type"],
                             buckets=8).awaitTermination()
    return read_stream_state(spark, state).select("key", "ts", "value", "event_type", "seq")


def risk_stream_reset(spark, sf_dir):
    """Two runs with a checkpoint each write to one fact: neither replaces the
    other's rows."""
    ensure_utc(spark)
    fact_path = scratch_path(spark, "risk-fact")
    q = quakes(spark, sf_dir).select("unid", "time", "lat", "lon", "mag")
    for half in (0, 1):
        inbox = scratch_path(spark, f"quake-inbox-{half}")
        q.filter(F.col("unid") % 2 == half).repartitionByRange(2, "unid").write.parquet(inbox)
        stream = read_change_stream(spark, "parquet", inbox, schema=q.schema, max_per_trigger=1)
        stream_risk(stream, ports(spark, sf_dir), fact_path, scratch_path(spark, "risk-ckpt"),
                    risk_options={"reason_format": "rounded", "round_digits": 6}).awaitTermination()
    return spark.read.parquet(fact_path).select(*RISK_COLUMNS)


RISK_COLUMNS = ["EARTHQUAKE_KEY", "PORT_KEY", "EARTHQUAKE_DATE_KEY", "DISTANCE_KM", "RISK_RADIUS_KM", "IS_NEARBY",
                "RISK_LEVEL", "RISK_REASON", "EVENT_YEAR", "EVENT_MONTH"]

register("cdc_stream_reset", ORACLE_SQL["cdc_apply"])(cdc_stream_reset)
register("risk_stream_reset", ORACLE_SQL["risk_fact"])(risk_stream_reset)
register("cdc_stream", ORACLE_SQL["cdc_apply"])(cdc_stream)
register("cdc_stream_bucketed", ORACLE_SQL["cdc_apply"])(cdc_stream_bucketed)
register("risk_stream", ORACLE_SQL["risk_fact"])(risk_stream)


@register("replay_stream", """
WITH e AS (SELECT event_id, event_id % 4 AS partition FROM events),
n AS (SELECT count(*) FILTER (WHERE event_id % 10 < 6) AS early, count(*) FILTER (WHERE event_id % 10 >= 6) AS late,
             (count(*) + 4) // 5 AS most FROM events)
SELECT CAST(partition AS INTEGER) AS partition, count(*) AS records, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
       count(*) AS offsets, CAST(sum(event_id) AS BIGINT) AS ids,
       any_value(CAST((n.early + n.most - 1) // n.most + (n.late + n.most - 1) // n.most AS BIGINT)) AS batches,
       any_value(CAST(least(n.most, greatest(n.early, n.late)) AS BIGINT)) AS largest_batch
FROM e, n GROUP BY partition""")
def replay_stream(spark, sf_dir):
    """A topic of four partitions read with a limit of a fifth of the events a
    batch: six tenths of them are there at first, the rest comes after the
    query has stopped, and a new one goes on from its checkpoint."""
    from quayside.sources.replay import ReplaySource, append_to_topic

    spark.dataSource.register(ReplaySource)
    e = table(spark, sf_dir, "events").select("event_id")
    most = -(-e.count() // 5)
    topic, out, checkpoint = (scratch_path(spark, n) for n in ("topic", "replayed", "replay-checkpoint"))
    partition, value = F.col("event_id") % 4, F.to_json(F.struct("event_id"))

    def store(batch, n):
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    following: dict[int, int] = {}
    early = F.col("event_id") % 10 < 6
    for records in (e.filter(early), e.filter(~early)):
        append_to_topic(records, topic, partition, value, ["event_id"], following, segment_rows=1000)
        stream = spark.readStream.format("replay").option("path", topic).option("checkpoint", checkpoint) \
            .option("maxOffsetsPerTrigger", most).load()
        query = run_stream(stream, store, checkpoint, trigger={"processingTime": "0 seconds"})
        query.processAllAvailable()
        query.stop()
        following = {r["partition"]: r["n"] for r in spark.read.parquet(out).groupBy("partition").agg((F.max("offset") + 1).alias("n")).collect()}
    got = spark.read.parquet(out)
    sizes = got.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("batches"), F.max("n").alias("largest")).first()
    ids = F.get_json_object("value", "$.event_id").cast("long")
    return got.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.countDistinct("offset").alias("offsets"), F.sum(ids).alias("ids"), F.lit(sizes["batches"]).cast("long").alias("batches"),
        F.lit(sizes["largest"]).cast("long").alias("largest_batch"))
