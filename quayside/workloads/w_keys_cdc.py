"""Surrogate keys, CDC merge, watermark and archive workloads
(W1, W2, J4, U1, A4, J6-J8, K9, K10, T6, K3, A16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators.cdc import apply_changes, change_counts, insert_if_absent, live_rows, upsert
from quayside.operators.keys import assign_surrogate_keys, dense_ids
from quayside.plans.archive import incremental_archive
from quayside.session import ensure_utc, scratch_path
from quayside.workloads import register
from quayside.workloads.fixtures import CHANGES_SQL, changes, table, with_ctes


@register("surrogate_initial", """
SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS port_key FROM customer""")
def surrogate_initial(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dense_ids(c, ["c_custkey"], "port_key", start=1)


@register("surrogate_incremental", """
WITH existing AS (
  SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS port_key
  FROM customer WHERE c_custkey % 3 = 0),
fresh AS (
  SELECT c.c_custkey, c.c_name FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.c_custkey = c.c_custkey))
SELECT c.c_custkey, c.c_name, e.port_key FROM customer c JOIN existing e USING (c_custkey)
UNION ALL
SELECT c_custkey, c_name,
       (SELECT max(port_key) FROM existing) + CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS port_key
FROM fresh""")
def surrogate_incremental(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # the existing registry: every third customer, keyed in business-key order
    existing = dense_ids(c.filter(F.col("c_custkey") % 3 == 0).select("c_custkey"), ["c_custkey"], "port_key")
    return assign_surrogate_keys(c, existing, "c_custkey", "port_key")


@register("cdc_counts", with_ctes(CHANGES_SQL) + """
SELECT count(*) FILTER (WHERE op IN ('c', 'r')) AS inserts, count(*) FILTER (WHERE op = 'u') AS updates,
       count(*) FILTER (WHERE op = 'd') AS deletes FROM changes""")
def cdc_counts(spark, sf_dir):
    return change_counts(changes(spark, sf_dir))


SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
SPLIT_TS = dt.datetime(2024, 1, 15)

LATEST_SQL = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM changes) WHERE rn = 1)"""


@register("cdc_apply", with_ctes(CHANGES_SQL, LATEST_SQL) + """
SELECT key, ts, value, event_type, seq FROM latest WHERE op <> 'd'""")
def cdc_apply(spark, sf_dir):
    ch = changes(spark, sf_dir)
    first = ch.filter(F.col("ts") <= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    second = ch.filter(F.col("ts") > F.lit(SPLIT_TS).cast("timestamp_ntz"))
    vals = ["ts", "value", "event_type"]
    state = apply_changes(None, first, ["key"], value_cols=vals)
    return apply_changes(state, second, ["key"], value_cols=vals).select("key", *vals, "seq")


# the MERGE rules one change at a time, in order: after SPLIT_TS an update needs a
# row, an insert needs that there is none, a delete removes it
STRICT_SQL = """, first AS (
  SELECT key, ts, value, event_type, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM changes WHERE ts <= {split}) WHERE rn = 1 AND op <> 'd'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS step FROM changes WHERE ts > {split}),
merged(key, step, present, ts, value, event_type, seq) AS (
  SELECT k.key, 0::BIGINT, f.seq IS NOT NULL, f.ts, f.value, f.event_type, f.seq
  FROM (SELECT DISTINCT key FROM changes) k LEFT JOIN first f ON k.key = f.key
  UNION ALL
  SELECT m.key, n.step,
         CASE WHEN n.op = 'd' THEN false WHEN n.op IN ('c', 'r') THEN true ELSE m.present END,
         CASE WHEN (n.op = 'u') = m.present AND n.op <> 'd' THEN n.ts ELSE m.ts END,
         CASE WHEN (n.op = 'u') = m.present AND n.op <> 'd' THEN n.value ELSE m.value END,
         CASE WHEN (n.op = 'u') = m.present AND n.op <> 'd' THEN n.event_type ELSE m.event_type END,
         CASE WHEN (n.op = 'u') = m.present AND n.op <> 'd' THEN n.seq ELSE m.seq END
  FROM merged m JOIN numbered n ON m.key = n.key AND n.step = m.step + 1)
SELECT key, ts, value, event_type, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY step DESC) AS rn FROM merged) WHERE rn = 1 AND present"""


@register("cdc_apply_strict", with_ctes(CHANGES_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + STRICT_SQL.format(split=SPLIT))
def cdc_apply_strict(spark, sf_dir):
    ch = changes(spark, sf_dir)
    first = ch.filter(F.col("ts") <= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    second = ch.filter(F.col("ts") > F.lit(SPLIT_TS).cast("timestamp_ntz"))
    vals = ["ts", "value", "event_type"]
    state = apply_changes(None, first, ["key"], value_cols=vals)
    return apply_changes(state, second, ["key"], value_cols=vals, mode="strict") \
        .select("key", *vals, "seq")


@register("cdc_strict_same_batch", with_ctes(CHANGES_SQL).replace("WITH ", "WITH RECURSIVE ", 1)
          + STRICT_SQL.format(split="TIMESTAMP '1900-01-01 00:00:00'"))
def cdc_strict_same_batch(spark, sf_dir):
    """All changes as one batch under the MERGE rules: creates, updates and
    deletes of a key come together."""
    return apply_changes(None, changes(spark, sf_dir), ["key"], value_cols=["ts", "value", "event_type"], mode="strict") \
        .select("key", "ts", "value", "event_type", "seq")


@register("cdc_ties", with_ctes(CHANGES_SQL) + """
, timed AS (SELECT key, epoch_ms(date_trunc('day', ts)) AS ms, seq AS position, op, value FROM changes)
SELECT key, ms, position, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ms DESC, position DESC) AS rn FROM timed) WHERE rn = 1 AND op <> 'd'""")
def cdc_ties(spark, sf_dir):
    """Times cut to the day, so most changes of a key tie, and the position in
    the log decides; two batches dealt by position parity, so each holds
    changes older and newer than the other's."""
    ch = changes(spark, sf_dir).select(
        "key", F.unix_millis(F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("ms"), F.col("seq").alias("position"), "op", "value")
    state = None
    for part in (1, 0):
        state = apply_changes(state, ch.filter(F.col("position") % 2 == part), ["key"], seq=["ms", "position"], value_cols=["value"],
                              tombstones=True)
    return live_rows(state).select("key", "ms", "position", "value")


# --- watermark control table derived from region -------------------------------

CONTROL_SQL = """control AS (
  SELECT r_name AS pipeline_name,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(r_regionkey) AS last_ingestion_date,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM region WHERE r_regionkey % 2 = 0)"""


def control_table(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    base = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    return r.filter(F.col("r_regionkey") % 2 == 0).select(
        F.col("r_name").alias("pipeline_name"),
        (base + F.make_dt_interval(F.col("r_regionkey"))).alias("last_ingestion_date"),
        base.alias("updated_at"))


@register("seed_if_absent", with_ctes(CONTROL_SQL) + """
SELECT * FROM control
UNION ALL
SELECT r_name, TIMESTAMP '1970-01-01 00:00:00', TIMESTAMP '1970-01-01 00:00:00' FROM region r
WHERE NOT EXISTS (SELECT 1 FROM control c WHERE c.pipeline_name = r.r_name)""")
def seed_if_absent(spark, sf_dir):
    epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    seeds = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("pipeline_name"), epoch.alias("last_ingestion_date"), epoch.alias("updated_at"))
    return insert_if_absent(control_table(spark, sf_dir), seeds, ["pipeline_name"])


AS_OF = dt.datetime(2024, 2, 1)


@register("watermark_upsert", with_ctes(CONTROL_SQL) + """
, upd AS (
  SELECT r.r_name AS pipeline_name, max(o.o_orderdate) AS last_ingestion_date,
         TIMESTAMP '2024-02-01 00:00:00' AS updated_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY r.r_name)
SELECT * FROM control c WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.pipeline_name = c.pipeline_name)
UNION ALL SELECT * FROM upd""")
def watermark_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # per-region high-water mark: orders are pre-aggregated per customer
    # before the (small) dimension joins
    per_cust = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("m"))
    upd = (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
           .join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
           .groupBy("r_name").agg(F.max("m").alias("last_ingestion_date"))
           .select(F.col("r_name").alias("pipeline_name"), "last_ingestion_date",
                   F.lit(AS_OF).cast("timestamp_ntz").alias("updated_at")))
    return upsert(control_table(spark, sf_dir), upd, ["pipeline_name"])


# --- incremental archive over events -------------------------------------------

def _archive_runs(spark, sf_dir):
    """Archive events in two runs split at 2024-01-15 and return the archive
    path plus each run's verification record."""
    ensure_utc(spark)
    src = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    archive = scratch_path(spark, "archive")
    control = scratch_path(spark, "control")
    upper = src.agg(F.max("ts").alias("m")).first()["m"]
    results = []
    for run_end in (SPLIT_TS, upper):
        results.append(incremental_archive(
            spark, src, archive_path=archive, control_base=control, pipeline="events_archive",
            slice_col="ts", event_ts="ts", keys=["event_id"], run_end=run_end, as_of=AS_OF))
    return archive, results


@register("archive_partitions", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def archive_partitions(spark, sf_dir):
    archive, _ = _archive_runs(spark, sf_dir)
    return spark.read.parquet(archive).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@register("archive_crash_rerun", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def archive_crash_rerun(spark, sf_dir):
    """The first run dies between its write and its watermark; the next one, with
    a later end, archives the same rows and more: every row is there once."""
    ensure_utc(spark)
    src = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    archive, control, lost = (scratch_path(spark, n) for n in ("archive-crash", "control-crash", "control-lost"))
    upper = src.agg(F.max("ts").alias("m")).first()["m"]
    for base, run_end in ((lost, SPLIT_TS), (control, upper)):  # a lost control table: a watermark that was never written
        incremental_archive(spark, src, archive_path=archive, control_base=base, pipeline="events_archive",
                            slice_col="ts", event_ts="ts", keys=["event_id"], run_end=run_end, as_of=AS_OF)
    return spark.read.parquet(archive).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@register("archive_same_second", """
SELECT event_id % 4 AS part, count(*) AS n FROM events GROUP BY 1""")
def archive_same_second(spark, sf_dir):
    """Four runs that end within one second, each with rows of its own."""
    ensure_utc(spark)
    base = dt.datetime(2024, 3, 1)
    src = table(spark, sf_dir, "events").select(
        "event_id", (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 4) / 10 + 0.05)).alias("arrived"))
    archive, control = scratch_path(spark, "archive-second"), scratch_path(spark, "control-second")
    for k in range(4):
        incremental_archive(spark, src, archive_path=archive, control_base=control, pipeline="p", slice_col="arrived",
                            event_ts="arrived", keys=["event_id"], run_end=base + dt.timedelta(milliseconds=100 * (k + 1)), as_of=AS_OF)
    return spark.read.parquet(archive).groupBy((F.col("event_id") % 4).alias("part")).agg(F.count(F.lit(1)).alias("n"))


@register("archive_reconcile", f"""
SELECT run, count(*) AS expected_rows, count(*) AS actual_rows, CAST(0 AS BIGINT) AS missing_rows,
       'OK' AS status
FROM (SELECT CASE WHEN ts <= {SPLIT} THEN 1 ELSE 2 END AS run FROM events) GROUP BY run""")
def archive_reconcile(spark, sf_dir):
    _, results = _archive_runs(spark, sf_dir)
    rows = [(i + 1, r.expected_rows, r.actual_rows, r.missing_rows, r.status) for i, r in enumerate(results)]
    return spark.createDataFrame(rows, "run int, expected_rows bigint, actual_rows bigint, "
                                       "missing_rows bigint, status string")

