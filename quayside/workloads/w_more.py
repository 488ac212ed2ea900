"""Sources, sinks, dimensions and checks that no other workload runs (S3, S9,
S10 rejects, K5, K7, K8, K11 as a publish, P14, A1, A7, W4, D3, D4, T7, D5 by
merges, B9)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from quayside.operators.dedupe import dedupe, distinct_rows
from quayside.operators.keys import KeyRegistry
from quayside.operators.quality import assert_not_empty, with_metrics
from quayside.operators.scd import scd2_merge
from quayside.operators.snapshot import apply_retention
from quayside.plans.archive import read_watermark, write_watermark
from quayside.plans.dims import dim_country, dim_vessel
from quayside.plans.quakes import ARCHIVE_COLUMNS, stage_quake_changes, to_archive_layout
from quayside.session import ensure_utc, scratch_path
from quayside.sinks.bucketed import read_bucketed, replace_into_bucketed
from quayside.sinks.tables import append_fact, publish, read_published, register_table, write_csv
from quayside.sources.files import month_snapshot, read_query
from quayside.sources.messages import decode_change_json, seismic_rejects
from quayside.workloads import register
from quayside.workloads.fixtures import QUAKES_SQL, quakes, table, with_ctes
from quayside.workloads.w_messages import quake_change_messages


@register("read_query", """
SELECT c_mktsegment AS segment, count(*) AS n, max(c_custkey) AS last_key FROM customer GROUP BY 1""")
def read_query_q(spark, sf_dir):
    view = f"customer_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, "customer").createOrReplaceTempView(view)
    return read_query(spark, f"SELECT c_mktsegment AS segment, count(*) AS n, max(c_custkey) AS last_key FROM {view} GROUP BY 1")


@register("month_snapshot", """
SELECT s_suppkey, s_name, DATE '2024-05-01' AS snapshot_date FROM supplier""")
def month_snapshot_q(spark, sf_dir):
    pulled = assert_not_empty(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    return month_snapshot(pulled, dt.date(2024, 5, 17))


def odd_messages(spark, sf_dir):
    """Messages by event id: cut off, without properties, with times of 17
    digits, empty coordinates, and good ones."""
    k = F.col("unid")
    time = F.when(k % 5 == 2, F.lit("99999999999999999")).when(k % 5 == 3, F.lit('"garbage"')).otherwise(F.lit("1700000000000"))
    whole = F.concat(F.lit('{"action":"create","data":{"geometry":{"coordinates":[]},"properties":{"unid":"'), k.cast("string"),
                     F.lit('","time":'), time, F.lit("}}}"))
    return quakes(spark, sf_dir).select(
        F.when(k % 5 == 0, F.substring(whole, 1, 40)).when(k % 5 == 1, F.lit('{"action":"create","data":{}}')).otherwise(whole).alias("value"), "unid")


@register("seismic_rejects", """
SELECT reason, count(*) AS n FROM (
  SELECT CASE event_id % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no properties' WHEN 4 THEN NULL ELSE 'time' END AS reason FROM events)
WHERE reason IS NOT NULL GROUP BY 1""")
def seismic_rejects_q(spark, sf_dir):
    return seismic_rejects(odd_messages(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("seismic_odd_times", """
SELECT CAST(event_id AS VARCHAR) AS unid, CASE WHEN event_id % 5 = 4 THEN make_timestamp(1700000000000000) END AS time, 0.0::DOUBLE AS lat
FROM events WHERE event_id % 5 > 1""")
def seismic_odd_times(spark, sf_dir):
    """A time out of range, or unreadable, is NULL; empty coordinates are 0."""
    from quayside.sources.messages import flatten_seismic_messages

    ensure_utc(spark)
    return flatten_seismic_messages(odd_messages(spark, sf_dir)).select("unid", "time", "lat")


@register("append_fact", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS EVENT_YEAR, CAST(month(o_orderdate) AS INTEGER) AS EVENT_MONTH, count(*) AS n
FROM orders GROUP BY 1, 2""")
def append_fact_q(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("int").alias("EVENT_YEAR"),
                                              F.month("o_orderdate").cast("int").alias("EVENT_MONTH"))
    path = scratch_path(spark, "appended")
    for part in (0, 1, 2):
        append_fact(o.filter(F.col("o_orderkey") % 3 == part), path)
    return spark.read.parquet(path).groupBy("EVENT_YEAR", "EVENT_MONTH").agg(F.count(F.lit(1)).alias("n"))


@register("external_table", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY 1""")
def external_table(spark, sf_dir):
    """An external table over partitioned files, found by partition repair and
    read through its name with a partition filter."""
    path, name = scratch_path(spark, "external"), f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("int").alias("y")).write.partitionBy("y").parquet(path)
    register_table(spark, name, path, "o_orderkey BIGINT, y INT", ["y"])
    return spark.table(name).filter("y >= 1996").groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@register("csv_round_trip", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part""")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv-out")
    write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name"), path)
    return spark.read.option("header", True).csv(path)


@register("retention_publish", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 DAY""")
def retention_publish(spark, sf_dir):
    """Retention as a table operation: the kept rows become the next version."""
    base = scratch_path(spark, "retained")
    publish(table(spark, sf_dir, "events").select("event_id", "ts"), base)
    publish(apply_retention(read_published(spark, base), "ts", "2 days", dt.datetime(2024, 1, 20)), base)
    return read_published(spark, base)


@register("archive_layout", """
SELECT 'q' || CAST(user_id AS VARCHAR) AS unid, make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_timestamp,
       CAST(2 + event_id % 7 AS DOUBLE) AS magnitude,
       CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS DATE) AS ingestion_date FROM events WHERE event_type <> 'error'""")
def archive_layout(spark, sf_dir):
    ensure_utc(spark)
    decoded = decode_change_json(quake_change_messages(spark, sf_dir)).filter(~F.col("_malformed"))
    laid = to_archive_layout(stage_quake_changes(decoded).filter("__op <> 'd'"))
    assert laid.columns == ARCHIVE_COLUMNS
    return laid.select("unid", "event_timestamp", "magnitude", "ingestion_date")


@register("write_metrics", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_type = 'error') AS errors, max(event_id) AS last_id FROM events""")
def write_metrics(spark, sf_dir):
    """Counts taken by the write itself."""
    observed, metrics = with_metrics(table(spark, sf_dir, "events"), f"events-{uuid.uuid4().hex[:8]}", n_rows=F.count(F.lit(1)),
                                     errors=F.count_if(F.col("event_type") == "error"), last_id=F.max("event_id"))
    observed.write.parquet(scratch_path(spark, "observed"))
    got = metrics.get
    return spark.createDataFrame([(got["n_rows"], got["errors"], got["last_id"])], "n_rows long, errors long, last_id long")


@register("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows_q(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@register("dedupe_fullest", """
SELECT user_id, count(*) > 0 AS has_named, max(CASE WHEN event_id % 4 = 0 THEN event_type END) AS name FROM events
WHERE event_id % 4 = 0 OR user_id NOT IN (SELECT user_id FROM events WHERE event_id % 4 = 0) GROUP BY user_id""")
def dedupe_fullest(spark, sf_dir):
    """Without an order the fullest row survives: a user's row with a name, of
    several the last by name; without any the row has none."""
    named = table(spark, sf_dir, "events").select(
        "user_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("name"))
    return dedupe(named, ["user_id"]).select("user_id", F.lit(True).alias("has_named"), "name")


@register("dim_country", """
SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS COUNTRY_KEY, code AS COUNTRY_CODE, min(n_name) AS COUNTRY_NAME
FROM (SELECT right(n_name, 1) AS code, n_name FROM nation) GROUP BY code""")
def dim_country_q(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.substring("n_name", -1, 1).alias("code"), "n_name")
    return dim_country(n.union(n), "code", "n_name")


@register("dim_vessel", """
SELECT CAST(row_number() OVER (ORDER BY detail_link) AS BIGINT) AS VESSEL_KEY, detail_link, max(s_suppkey) AS s_suppkey
FROM (SELECT '/vessels/' || CAST(s_suppkey % 7 AS VARCHAR) AS detail_link, s_suppkey FROM supplier) GROUP BY detail_link""")
def dim_vessel_q(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/vessels/"), (F.col("s_suppkey") % 7).cast("string")).alias("detail_link"), "s_suppkey")
    return dim_vessel(s, order=["s_suppkey"]).select("VESSEL_KEY", "detail_link", "s_suppkey")


@register("key_registry", """
SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey % 2 = 0, s_suppkey) AS BIGINT) AS port_key FROM supplier""")
def key_registry(spark, sf_dir):
    """Odd suppliers are known first; all come later: the known keep their keys."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    registry = KeyRegistry(spark, scratch_path(spark, "key-registry"), "s_suppkey", "port_key")
    registry.assign(s.filter("s_suppkey % 2 = 1"))
    return registry.assign(s).select("s_suppkey", "port_key")


@register("watermark_read", """
SELECT r_name AS pipeline, CASE WHEN r_regionkey % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(r_regionkey)
       ELSE TIMESTAMP '1970-01-01 00:00:00' END AS watermark FROM region""")
def watermark_read(spark, sf_dir):
    """A pipeline without a watermark starts at the epoch. Five pipelines."""
    base, names = scratch_path(spark, "watermarks"), table(spark, sf_dir, "region").select("r_name", "r_regionkey").collect()
    for r in names:
        if r.r_regionkey % 2 == 0:
            write_watermark(spark, base, r.r_name, dt.datetime(2024, 1, 1) + dt.timedelta(days=r.r_regionkey), dt.datetime(2024, 1, 1))
    return spark.createDataFrame([(r.r_name, read_watermark(spark, base, r.r_name)) for r in names], "pipeline string, watermark timestamp_ntz")


@register("scd2_merged", """
WITH snap AS (
  SELECT s_suppkey AS k, m, CASE WHEN s_suppkey % 5 = m THEN 'changed' ELSE 'plain' END AS status
  FROM supplier, (SELECT unnest([1, 2, 3]) AS m) WHERE s_suppkey % 7 <> m),
l AS (SELECT *, lag(m) OVER w AS pm, lag(status) OVER w AS ps FROM snap WINDOW w AS (PARTITION BY k ORDER BY m)),
v AS (SELECT *, sum(CASE WHEN pm = m - 1 AND ps = status THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY m) AS ver FROM l)
SELECT k, any_value(status) AS status, make_date(2024, min(m)::INTEGER, 1) AS effective_from,
       CASE WHEN max(m) < 3 THEN make_date(2024, max(m)::INTEGER + 1, 1) END AS effective_to, max(m) = 3 AS is_current FROM v GROUP BY k, ver""")
def scd2_merged(spark, sf_dir):
    """Three monthly snapshots merged one after the other; a supplier is missing
    from one month, and changed in another."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    current = spark.createDataFrame([], "k long, status string, effective_from date, effective_to date, is_current boolean")
    for m in (1, 2, 3):
        snap = s.filter(F.col("k") % 7 != m).withColumn("status", F.when(F.col("k") % 5 == m, "changed").otherwise("plain"))
        current = scd2_merge(current, snap, ["k"], ["status"], dt.date(2024, m, 1)).checkpoint()
    return current


@register("replace_mode", with_ctes(QUAKES_SQL) + """
SELECT CAST(unid % 40 AS VARCHAR) AS EARTHQUAKE_KEY, max(unid) AS _SEQ, arg_max(mag, unid) AS mag FROM quakes GROUP BY 1""")
def replace_mode(spark, sf_dir):
    """Rows of a key replace its stored ones, and older ones that come later do
    not: three batches, the newest rows second."""
    q = quakes(spark, sf_dir).select((F.col("unid") % 40).cast("string").alias("EARTHQUAKE_KEY"), F.col("unid").alias("_SEQ"), "mag")
    base = scratch_path(spark, "replaced")
    third = F.pmod(F.col("_SEQ"), F.lit(3))
    for n, part in enumerate((0, 2, 1)):
        batch = dedupe(q.filter(third == part), ["EARTHQUAKE_KEY"], order=["_SEQ"])
        replace_into_bucketed(spark, base, batch, ["EARTHQUAKE_KEY"], batch_id=n, buckets=4, seq="_SEQ")
    return read_bucketed(spark, base, live=False).select("EARTHQUAKE_KEY", "_SEQ", "mag")
