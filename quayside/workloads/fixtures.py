"""Inputs derived from the driver's tables, written once in Spark and once as
SQL common-table expressions so both engines see identical rows.

The arithmetic is fixed (see FIXTURES.md section 3); it only maps the driver's
keys onto the reference's data model (quakes, ports, changes, snapshots).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- quakes from events --------------------------------------------------------

def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("unid"),
        F.col("ts").alias("time"),
        (((eid * 37) % 140 - 70).cast("double") + 0.5).alias("lat"),
        (((eid * 53) % 360 - 180).cast("double") + 0.5).alias("lon"),
        (2 + eid % 7).cast("double").alias("mag"),
        (eid % 50).cast("double").alias("depth"),
        F.col("event_type").alias("flynn_region"),
        F.col("user_id"),
    )


QUAKES_SQL = """quakes AS (
  SELECT event_id AS unid, ts AS time,
         CAST((event_id * 37) % 140 - 70 AS DOUBLE) + 0.5 AS lat,
         CAST((event_id * 53) % 360 - 180 AS DOUBLE) + 0.5 AS lon,
         CAST(2 + event_id % 7 AS DOUBLE) AS mag,
         CAST(event_id % 50 AS DOUBLE) AS depth,
         event_type AS flynn_region, user_id
  FROM events)"""


# --- ports from supplier -------------------------------------------------------

def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("port_key"),
        (((k * 29) % 140 - 70).cast("double") + 0.25).alias("port_latitude"),
        (((k * 71) % 360 - 180).cast("double") + 0.25).alias("port_longitude"),
        F.col("s_nationkey").alias("country_key"),
        F.col("s_name").alias("port_name"),
    )


PORTS_SQL = """ports AS (
  SELECT s_suppkey AS port_key,
         CAST((s_suppkey * 29) % 140 - 70 AS DOUBLE) + 0.25 AS port_latitude,
         CAST((s_suppkey * 71) % 360 - 180 AS DOUBLE) + 0.25 AS port_longitude,
         s_nationkey AS country_key, s_name AS port_name
  FROM supplier)"""


# --- changes from events -------------------------------------------------------
# Event type -> change operation
OP_OF_EVENT_TYPE = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    op = None
    for et, o in OP_OF_EVENT_TYPE.items():
        op = F.when(F.col("event_type") == et, F.lit(o)) if op is None else op.when(F.col("event_type") == et, F.lit(o))
    return e.select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        F.col("ts"),
        F.col("value"),
        F.col("event_type"),
    )


CHANGES_SQL = """changes AS (
  SELECT user_id AS key, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u'
                         WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' END AS op,
         ts, value, event_type
  FROM events)"""


# --- monthly snapshots from orders --------------------------------------------

def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("oid"),
        F.col("o_orderkey"),
        F.col("o_orderstatus"),
        F.col("o_totalprice"),
        F.year("o_orderdate").cast("int").alias("snapshot_year"),
        F.month("o_orderdate").cast("int").alias("snapshot_month"),
    )


SNAPSHOTS_SQL = """snapshots AS (
  SELECT o_custkey AS oid, o_orderkey, o_orderstatus, o_totalprice,
         CAST(year(o_orderdate) AS INTEGER) AS snapshot_year,
         CAST(month(o_orderdate) AS INTEGER) AS snapshot_month
  FROM orders)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
