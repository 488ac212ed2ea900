"""Bitmap rollups under dashboard slices (A9, A11, A14), content verification
of a written archive (Q6, A16) and retention by partition (K11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators.bitmaps import bitmap_rollup, distinct_in, id_numbers
from quayside.operators.fingerprint import compare_content
from quayside.session import ensure_utc, scratch_path
from quayside.sinks.tables import expire_partitions
from quayside.workloads import register
from quayside.workloads.fixtures import table

SLICE_SQL = "count(DISTINCT user_id) AS ids, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers"


@register("kpi_rollup_slices", f"""
WITH e AS (SELECT *, CAST(ts AS DATE) AS day, event_id % 3 AS region FROM events), m AS (SELECT max(day) AS last FROM e)
SELECT 'region ' || CAST(region AS VARCHAR) AS slice, {SLICE_SQL} FROM e GROUP BY region
UNION ALL SELECT 'all', {SLICE_SQL} FROM e
UNION ALL SELECT 'last 3 days', {SLICE_SQL} FROM e, m WHERE day > m.last - 3
UNION ALL SELECT 'region 1, first days', {SLICE_SQL} FROM e, m WHERE day <= m.last - 3 AND region = 1""")
def kpi_rollup_slices(spark, sf_dir):
    """Distinct users and buyers of four slices, read from a rollup by day and
    region. All days but the last are there first; the last one is added with
    numbers for its new users."""
    ensure_utc(spark)
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), (F.col("event_id") % 3).alias("region"))
    last = e.agg(F.max("day").alias("d")).first()["d"]
    path, names = scratch_path(spark, "bitmaps"), scratch_path(spark, "user-numbers")
    numbers = None
    for run, part in enumerate((e.filter(F.col("day") < F.lit(last)), e.filter(F.col("day") == F.lit(last)))):
        id_numbers(part, "user_id", numbers).write.parquet(f"{names}/{run}")
        numbers = spark.read.parquet(f"{names}/{run}")
        rolled = bitmap_rollup(part, numbers, "user_id", ["day", "region"], {"buyers": F.col("event_type") == "purchase"})
        rolled.write.mode("append").partitionBy("day").parquet(path)
    rollup, day = spark.read.parquet(path), F.col("day")
    recent = day > F.date_sub(F.lit(last), 3)
    slices = [("all", rollup), ("last 3 days", rollup.filter(recent)), ("region 1, first days", rollup.filter(~recent & (F.col("region") == 1)))]
    out = distinct_in(rollup, ["region"], ["ids", "buyers"]).select(F.concat(F.lit("region "), F.col("region").cast("string")).alias("slice"), "ids", "buyers")
    for name, rows in slices:
        out = out.unionByName(distinct_in(rows, [], ["ids", "buyers"]).select(F.lit(name).alias("slice"), "ids", "buyers"))
    return out


TAMPERED_SQL = """WITH e AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events),
d AS (SELECT day, row_number() OVER (ORDER BY day) AS n FROM (SELECT DISTINCT day FROM e)),
x AS (SELECT e.*, d.n, e.event_id = min(e.event_id) OVER (PARTITION BY e.day) AS first, e.event_id = max(e.event_id) OVER (PARTITION BY e.day) AS last
      FROM e JOIN d USING (day)),
a AS (
  SELECT event_id, user_id, CASE WHEN n = 2 AND first THEN NULL ELSE event_type END AS event_type,
         CASE WHEN n = 3 AND first THEN value + 1 ELSE value END AS value, day FROM x WHERE n <> 4 AND NOT (n IN (5, 6) AND last)
  UNION ALL SELECT event_id, user_id, event_type, value, day FROM x WHERE n = 6 AND first
  UNION ALL SELECT event_id, user_id, event_type, value, DATE '1999-01-01' FROM x WHERE n = 1 AND first),
ec AS (SELECT day, count(*) AS rows FROM e GROUP BY day), ac AS (SELECT day, count(*) AS rows FROM a GROUP BY day),
changed AS (SELECT DISTINCT day FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a))
SELECT coalesce(ec.day, ac.day) AS day, coalesce(ec.rows, 0) AS expected_rows, coalesce(ac.rows, 0) AS actual_rows,
       CASE WHEN ac.day IS NULL THEN 'MISSING' WHEN ec.day IS NULL THEN 'EXTRA' WHEN ec.rows <> ac.rows THEN 'ROWS'
            WHEN ec.day IN (SELECT day FROM changed) THEN 'CONTENT' ELSE 'OK' END AS status
FROM ec FULL JOIN ac ON ec.day = ac.day"""


@register("archive_content", TAMPERED_SQL)
def archive_content(spark, sf_dir):
    """An archive by day, damaged after it was written: a NULL in place of a
    value, a changed value, a lost day, a lost row, a row in another's place,
    and a day too many. Each is found, and the other days are in order."""
    ensure_utc(spark)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    days = e.groupBy("day").agg(F.min("event_id").alias("_min"), F.max("event_id").alias("_max"))
    known = sorted(r["day"] for r in days.select("day").collect())[:6]  # the first six days, as literals
    n = sum((F.when(F.col("day") == d, k).otherwise(0) for k, d in enumerate(known, 1)), F.lit(0))
    x = e.join(days, "day").withColumn("_n", n)
    first, last, cols = F.col("event_id") == F.col("_min"), F.col("event_id") == F.col("_max"), ["event_id", "user_id", "event_type", "value"]
    damaged = x.filter((F.col("_n") != 4) & ~(F.col("_n").isin(5, 6) & last)).withColumns({
        "event_type": F.when(~((F.col("_n") == 2) & first), F.col("event_type")),
        "value": F.when((F.col("_n") == 3) & first, F.col("value") + 1).otherwise(F.col("value"))})
    damaged = damaged.select(*cols, "day").unionByName(x.filter((F.col("_n") == 6) & first).select(*cols, "day")) \
        .unionByName(x.filter((F.col("_n") == 1) & first).select(*cols, F.lit("1999-01-01").cast("date").alias("day")))
    path = scratch_path(spark, "damaged-archive")
    damaged.write.partitionBy("day").parquet(path)
    return compare_content(e, spark.read.parquet(path), ["day"])


@register("retention_partitions", """
WITH e AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN ts END AS seen FROM events), m AS (SELECT max(ts) AS last FROM events)
SELECT event_id, user_id, event_type FROM e, m WHERE seen IS NULL OR seen >= last - INTERVAL 30 HOUR""")
def retention_partitions(spark, sf_dir):
    """Three runs of a retention of 30 hours, at ends 20 days, 9 hours and 0
    hours before the last event, over a table by day; some rows have no time."""
    ensure_utc(spark)
    path = scratch_path(spark, "events-by-day")
    e = table(spark, sf_dir, "events")
    seen = F.when(F.col("event_id") % 11 != 0, F.col("ts")).cast("timestamp_ntz")
    e.select("event_id", "user_id", "event_type", seen.alias("seen")).withColumn("day", F.to_date("seen")) \
        .hint("rebalance", "day").write.partitionBy("day").parquet(path)
    last = e.agg(F.max(F.col("ts").cast("timestamp_ntz")).alias("last")).first()["last"]
    for hours in (480, 9, 0):
        expire_partitions(spark, path, "seen", last - dt.timedelta(hours=hours + 30))
    kind = "event_id long, user_id long, event_type string, seen timestamp_ntz, day date"
    return spark.read.schema(kind).parquet(path).select("event_id", "user_id", "event_type")
