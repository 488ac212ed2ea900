"""Cleaning, conformance, quality, snapshot and flag workloads
(P1-P9, Q1-Q2, A2, A6, F1, F2, K11, X1-X3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.flags import add_communication_metrics, add_supply_metrics
from quayside.functions.names import standardize_name
from quayside.operators.clean import blank_to_null, cast_to_spec, conform, trim_strings
from quayside.operators.dedupe import dedupe
from quayside.operators.quality import check_columns, expect_not_null, null_report
from quayside.operators.snapshot import apply_retention, incremental_slice, latest_snapshot
from quayside.workloads import register
from quayside.workloads.fixtures import SNAPSHOTS_SQL, snapshots, table, with_ctes


@register("latest_snapshot", with_ctes(SNAPSHOTS_SQL) + """
SELECT * FROM snapshots
WHERE (snapshot_year, snapshot_month) = (
  SELECT (snapshot_year, snapshot_month) FROM snapshots
  ORDER BY snapshot_year DESC, snapshot_month DESC LIMIT 1)""")
def latest_snapshot_q(spark, sf_dir):
    return latest_snapshot(snapshots(spark, sf_dir))


@register("dedupe_latest", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT user_id, event_id, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def dedupe_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedupe(e, ["user_id"], order=["ts", "event_id"], keep="last")


# --- raw strings derived from part -------------------------------------------------

def raw_part(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k,
        F.when(k % 5 == 0, F.lit("   ")).when(k % 5 == 1, F.lit("")).otherwise(F.col("p_brand")).alias("brand_raw"),
        F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")).alias("type_raw"),
        F.when(k % 7 == 0, F.lit("abc")).when(k % 7 == 1, F.lit(" "))
         .otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))).alias("size_raw"),
        F.format_string("%.2f", F.col("p_retailprice")).alias("price_raw"),
    )


RAW_PART_SQL = """raw_part AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 5 = 0 THEN '   ' WHEN p_partkey % 5 = 1 THEN '' ELSE p_brand END AS brand_raw,
         '  ' || p_type || ' ' AS type_raw,
         CASE WHEN p_partkey % 7 = 0 THEN 'abc' WHEN p_partkey % 7 = 1 THEN ' '
              ELSE ' ' || CAST(p_size AS VARCHAR) || ' ' END AS size_raw,
         printf('%.2f', p_retailprice) AS price_raw
  FROM part)"""


@register("blank_to_null", with_ctes(RAW_PART_SQL) + """
SELECT p_partkey,
       CASE WHEN trim(brand_raw) = '' THEN NULL ELSE brand_raw END AS brand_raw,
       CASE WHEN trim(type_raw) = '' THEN NULL ELSE type_raw END AS type_raw,
       CASE WHEN trim(size_raw) = '' THEN NULL ELSE size_raw END AS size_raw,
       CASE WHEN trim(price_raw) = '' THEN NULL ELSE price_raw END AS price_raw
FROM raw_part""")
def blank_to_null_q(spark, sf_dir):
    return blank_to_null(raw_part(spark, sf_dir))


@register("trim_cast", with_ctes(RAW_PART_SQL) + """
SELECT p_partkey,
       nullif(trim(brand_raw), '') AS brand,
       trim(type_raw) AS p_type,
       TRY_CAST(nullif(trim(size_raw), '') AS INTEGER) AS p_size,
       TRY_CAST(trim(price_raw) AS DOUBLE) AS p_retailprice
FROM raw_part""")
def trim_cast(spark, sf_dir):
    df = raw_part(spark, sf_dir).toDF("p_partkey", "brand", "p_type", "p_size", "p_retailprice")
    # order: blank -> NULL, trim, typed cast (bad values become NULL)
    df = trim_strings(blank_to_null(df))
    return cast_to_spec(df, {"p_size": "int", "p_retailprice": "double"})


@register("standard_names", """
SELECT p_partkey, raw_name,
  replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(raw_name)),
    '([a-z])-([0-9])', '\\1\\2', 'g'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'),
    'lifts_100_tons', 'lifts_100_plus_tons') AS standard_name
FROM (SELECT p_partkey, ' ' || p_type || '-' || CAST(p_size AS VARCHAR) || ' (' || p_brand || ')' AS raw_name
      FROM part)""")
def standard_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.col("p_type"), F.lit("-"), F.col("p_size").cast("string"),
                   F.lit(" ("), F.col("p_brand"), F.lit(")"))
    return p.select("p_partkey", raw.alias("raw_name")) \
        .withColumn("standard_name", standardize_name("raw_name"))


# --- customer with derived NULLs ----------------------------------------------------

def customer_with_nulls(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k,
        F.when(k % 7 != 0, F.col("c_name")).alias("c_name"),
        F.when(k % 17 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(k % 11 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 13 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


CUSTOMER_NULLS_SQL = """cn AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name,
         CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey END AS c_nationkey,
         CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer)"""

CUSTOMER_SPEC = {"required": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                 "not_null": ["c_custkey", "c_name", "c_acctbal"]}


@register("null_report", with_ctes(CUSTOMER_NULLS_SQL) + """
SELECT 'c_custkey' AS column_name, CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT) AS null_count FROM cn
UNION ALL SELECT 'c_name', CAST(count(*) FILTER (WHERE c_name IS NULL) AS BIGINT) FROM cn
UNION ALL SELECT 'c_nationkey', CAST(count(*) FILTER (WHERE c_nationkey IS NULL) AS BIGINT) FROM cn
UNION ALL SELECT 'c_acctbal', CAST(count(*) FILTER (WHERE c_acctbal IS NULL) AS BIGINT) FROM cn
UNION ALL SELECT 'c_mktsegment', CAST(count(*) FILTER (WHERE c_mktsegment IS NULL) AS BIGINT) FROM cn""")
def null_report_q(spark, sf_dir):
    return null_report(customer_with_nulls(spark, sf_dir), CUSTOMER_SPEC["required"])


@register("column_check", with_ctes(CUSTOMER_NULLS_SQL) + """
SELECT c_custkey, failed_columns FROM (
  SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey IS NULL THEN 'c_custkey' END,
                                   CASE WHEN c_name IS NULL THEN 'c_name' END,
                                   CASE WHEN c_acctbal IS NULL THEN 'c_acctbal' END) AS failed_columns
  FROM cn) WHERE failed_columns <> ''""")
def column_check(spark, sf_dir):
    df = customer_with_nulls(spark, sf_dir)
    check_columns(df, CUSTOMER_SPEC["required"], allow_extra=False)
    return expect_not_null(df, CUSTOMER_SPEC["not_null"], keep=["c_custkey"])


@register("conform_fill", """
SELECT n_nationkey, n_name, '' AS n_comment, n_regionkey FROM nation""")
def conform_fill(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return conform(n, ["n_nationkey", "n_name", "n_comment", "n_regionkey"], missing="fill", fill="")


# --- availability flags derived from part ------------------------------------------

def port_flags(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")

    def pick(v, options):
        e = None
        for i, o in enumerate(options):
            val = F.lit(o) if o is not None else F.lit(None).cast("string")
            e = F.when(v == i, val) if e is None else e.when(v == i, val)
        return e

    return p.select(
        k.alias("oid"),
        pick(k % 6, ["Yes", " y ", "No", "Unknown", "", None]).alias("supplies_provisions"),
        pick(s % 4, ["TRUE", "n", "Available", "0"]).alias("supplies_fuel_oil"),
        pick(k % 5, ["1", "unavailable", " YES", "false", None]).alias("supplies_diesel_oil"),
        pick((k + s) % 3, ["y", "no", "  "]).alias("supplies_potable_water"),
        pick(s % 3, ["available", "N", "maybe"]).alias("repairs"),
        pick(k % 4, ["Y", "N", "true", None]).alias("communications_radio"),
        pick(s % 5, ["yes", "1", "0", "Unavailable", "TRUE"]).alias("communications_telephone"),
        pick((k * 3 + s) % 4, ["available", "", "no", "y"]).alias("communications_airport"),
        pick(k % 3, ["1", "Yes", "x"]).alias("communications_telefax"),
    )


def _case(expr, options):
    parts = " ".join(f"WHEN {i} THEN {'NULL' if o is None else repr(o)}" for i, o in enumerate(options))
    return f"CASE {expr} {parts} END"


PORT_FLAGS_SQL = f"""flags AS (
  SELECT p_partkey AS oid,
    {_case('p_partkey % 6', ['Yes', ' y ', 'No', 'Unknown', '', None])} AS supplies_provisions,
    {_case('p_size % 4', ['TRUE', 'n', 'Available', '0'])} AS supplies_fuel_oil,
    {_case('p_partkey % 5', ['1', 'unavailable', ' YES', 'false', None])} AS supplies_diesel_oil,
    {_case('(p_partkey + p_size) % 3', ['y', 'no', '  '])} AS supplies_potable_water,
    {_case('p_size % 3', ['available', 'N', 'maybe'])} AS repairs,
    {_case('p_partkey % 4', ['Y', 'N', 'true', None])} AS communications_radio,
    {_case('p_size % 5', ['yes', '1', '0', 'Unavailable', 'TRUE'])} AS communications_telephone,
    {_case('(p_partkey * 3 + p_size) % 4', ['available', '', 'no', 'y'])} AS communications_airport,
    {_case('p_partkey % 3', ['1', 'Yes', 'x'])} AS communications_telefax
  FROM part)"""


def _flag_sql(c):
    return f"(CASE WHEN lower(trim({c})) IN ('1','y','yes','true','available') THEN 1 ELSE 0 END)"


SUPPLY_SUM = " + ".join(_flag_sql(c) for c in ["supplies_provisions", "supplies_fuel_oil", "supplies_diesel_oil",
                                               "supplies_potable_water", "repairs"])
COMM_SUM = " + ".join(_flag_sql(c) for c in ["communications_radio", "communications_telephone",
                                             "communications_airport", "communications_telefax"])


@register("availability_score", with_ctes(PORT_FLAGS_SQL) + f"""
SELECT oid, supplies_count,
       CASE WHEN supplies_count = 5 THEN 'Excellent' WHEN supplies_count BETWEEN 3 AND 4 THEN 'Good'
            WHEN supplies_count BETWEEN 1 AND 2 THEN 'Limited' ELSE 'Unavailable' END AS supplies_rate
FROM (SELECT oid, CAST({SUPPLY_SUM} AS INTEGER) AS supplies_count FROM flags)""")
def availability_score(spark, sf_dir):
    return add_supply_metrics(port_flags(spark, sf_dir)).select("oid", "supplies_count", "supplies_rate")


@register("rate_bands", with_ctes(PORT_FLAGS_SQL) + f"""
SELECT oid, communications_count,
       CASE WHEN communications_count = 4 THEN 'Excellent' WHEN communications_count = 3 THEN 'Good'
            WHEN communications_count BETWEEN 1 AND 2 THEN 'Limited' ELSE 'Unavailable' END AS comm_rate
FROM (SELECT oid, CAST({COMM_SUM} AS INTEGER) AS communications_count FROM flags)""")
def rate_bands(spark, sf_dir):
    return add_communication_metrics(port_flags(spark, sf_dir)).select("oid", "communications_count", "comm_rate")


# --- time slices over events -------------------------------------------------------

@register("incremental_slice", """
SELECT event_id, user_id, ts, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def incremental_slice_q(spark, sf_dir):
    import datetime as dt
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return incremental_slice(e, "ts", after=dt.datetime(2024, 1, 10), up_to=dt.datetime(2024, 1, 20))


@register("retention", """
SELECT event_id, ts FROM events
WHERE ts IS NULL OR ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def retention(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    as_of = e.agg(F.max("ts").alias("m")).first()["m"]
    return apply_retention(e, "ts", "2 days", as_of)
