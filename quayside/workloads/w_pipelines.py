"""End-to-end pipeline workloads: landing, silver, gold, SCD2 history and
vessel facts (S1, S8, D5, D8-D12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators.scd import scd2
from quayside.plans.facts import vessel_port_risk, vessel_snapshot, vessel_trip
from quayside.plans.gold import port_dimension
from quayside.plans.risk import risk_fact
from quayside.plans.silver import build_silver
from quayside.session import ensure_utc, scratch_path
from quayside.sources.files import CSV_QUOTING, land_dated_files, read_snapshot_csv
from quayside.spec import SchemaSpec
from quayside.workloads import register
from quayside.workloads.fixtures import ports, quakes, table, with_ctes
from quayside.workloads.w_clean import PORT_FLAGS_SQL, port_flags
from quayside.workloads.w_model import FACT_CTE

FLAG_COLUMNS = ["supplies_provisions", "supplies_fuel_oil", "supplies_diesel_oil", "supplies_potable_water",
                "repairs", "communications_radio", "communications_telephone", "communications_airport",
                "communications_telefax"]
# landed headers are free text; the standard-name rule maps them to the spec
RAW_HEADERS = {"oid": "OID_", "main_port_name": "Main Port Name", "channel_depth_m": "Channel Depth (m)",
               "maximum_vessel_draft_m": "Maximum Vessel Draft (m)",
               "supplies_provisions": "Supplies - Provisions", "supplies_fuel_oil": "Supplies - Fuel Oil",
               "supplies_diesel_oil": "Supplies - Diesel Oil", "supplies_potable_water": "Supplies-Potable Water",
               "repairs": "Repairs", "communications_radio": "Communications - Radio",
               "communications_telephone": "Communications - Telephone",
               "communications_airport": "Communications - Airport",
               "communications_telefax": "Communications - Telefax"}

PORT_SPEC = SchemaSpec.from_dict({
    "validation": {"required_columns": list(RAW_HEADERS), "allow_extra_columns": False,
                   "allow_missing_columns": False, "allow_empty_file": False},
    "columns": {"oid": {"type": "integer", "nullable": False}, "main_port_name": {"type": "string"},
                "channel_depth_m": {"type": "double"}, "maximum_vessel_draft_m": {"type": "double"},
                **{c: {"type": "string"} for c in FLAG_COLUMNS}},
    "partition_columns": {"snapshot_year": "integer", "snapshot_month": "integer"},
    "business_key": ["oid"],
    "gold_columns": ["port_key", "oid", "main_port_name", "channel_depth_m", "maximum_vessel_draft_m",
                     "supplies_count", "supplies_rate", "communications_count", "comm_rate"],
})


def land_raw_ports(spark, sf_dir) -> str:
    """Raw monthly port CSVs (free-text headers, year=/month= folders) derived
    from ``part``; every 50th port appears twice in its month."""
    f = port_flags(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k = F.col("p_partkey")
    rows = p.join(f, k == f.oid).select(
        k.cast("string").alias(RAW_HEADERS["oid"]),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias(RAW_HEADERS["main_port_name"]),
        F.when(k % 8 == 0, F.lit("")).when(k % 8 == 1, F.lit("abc")).otherwise(F.col("p_size").cast("string"))
         .alias(RAW_HEADERS["channel_depth_m"]),
        (F.col("p_size") * 1.5).cast("string").alias(RAW_HEADERS["maximum_vessel_draft_m"]),
        *[F.col(c).alias(RAW_HEADERS[c]) for c in FLAG_COLUMNS],
        F.lit(2024).alias("year"), (1 + k % 3).alias("month"))
    rows = rows.unionByName(rows.filter(F.col(RAW_HEADERS["oid"]).cast("int") % 50 == 0))
    path = scratch_path(spark, "landed-ports")
    rows.write.option("header", True).partitionBy("year", "month").csv(path)
    return path


SILVER_EXPECTED = with_ctes(PORT_FLAGS_SQL) + """
, silver AS (
  SELECT CAST(p.p_partkey AS INTEGER) AS oid, trim(p.p_name) AS main_port_name,
         CASE WHEN p.p_partkey % 8 IN (0, 1) THEN NULL ELSE CAST(p.p_size AS DOUBLE) END AS channel_depth_m,
         CAST(p.p_size * 1.5 AS DOUBLE) AS maximum_vessel_draft_m,
         nullif(trim(f.supplies_provisions), '') AS supplies_provisions,
         nullif(trim(f.supplies_fuel_oil), '') AS supplies_fuel_oil,
         nullif(trim(f.supplies_diesel_oil), '') AS supplies_diesel_oil,
         nullif(trim(f.supplies_potable_water), '') AS supplies_potable_water,
         nullif(trim(f.repairs), '') AS repairs,
         nullif(trim(f.communications_radio), '') AS communications_radio,
         nullif(trim(f.communications_telephone), '') AS communications_telephone,
         nullif(trim(f.communications_airport), '') AS communications_airport,
         nullif(trim(f.communications_telefax), '') AS communications_telefax,
         2024 AS snapshot_year, CAST(1 + p.p_partkey % 3 AS INTEGER) AS snapshot_month
  FROM part p JOIN flags f ON f.oid = p.p_partkey)
"""


def _silver(spark, sf_dir):
    raw = read_snapshot_csv(spark, land_raw_ports(spark, sf_dir))
    out = scratch_path(spark, "silver-ports")
    build_silver(raw, PORT_SPEC, out)
    return spark.read.parquet(out)


@register("silver_build", SILVER_EXPECTED + "SELECT * FROM silver")
def silver_build(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.select(*PORT_SPEC.names, "snapshot_year", "snapshot_month")


def _flag(c):
    return f"(CASE WHEN lower(trim({c})) IN ('1','y','yes','true','available') THEN 1 ELSE 0 END)"


@register("port_dimension", SILVER_EXPECTED + f"""
, cur AS (SELECT * FROM silver WHERE snapshot_month = (SELECT max(snapshot_month) FROM silver)),
scored AS (
  SELECT *, CAST({' + '.join(_flag(c) for c in FLAG_COLUMNS[:5])} AS INTEGER) AS supplies_count,
            CAST({' + '.join(_flag(c) for c in FLAG_COLUMNS[5:])} AS INTEGER) AS communications_count
  FROM cur)
SELECT CAST(row_number() OVER (ORDER BY oid) AS BIGINT) AS port_key, oid, main_port_name, channel_depth_m,
       maximum_vessel_draft_m, supplies_count,
       CASE WHEN supplies_count = 5 THEN 'Excellent' WHEN supplies_count BETWEEN 3 AND 4 THEN 'Good'
            WHEN supplies_count BETWEEN 1 AND 2 THEN 'Limited' ELSE 'Unavailable' END AS supplies_rate,
       communications_count,
       CASE WHEN communications_count = 4 THEN 'Excellent' WHEN communications_count = 3 THEN 'Good'
            WHEN communications_count BETWEEN 1 AND 2 THEN 'Limited' ELSE 'Unavailable' END AS comm_rate
FROM scored""")
def port_dimension_q(spark, sf_dir):
    return port_dimension(_silver(spark, sf_dir), PORT_SPEC.output_columns)


@register("land_partitions", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
FROM orders WHERE year(o_orderdate) <> 1995 GROUP BY 1, 2""")
def land_partitions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # one landed file per order date; files of 1995 carry a malformed name
    name = F.when(F.year("o_orderdate") == 1995,
                  F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".csv"))) \
        .otherwise(F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")))
    src = scratch_path(spark, "sftp-drop")
    o.withColumn("landing", name).drop("o_orderdate").repartition("landing") \
        .write.option("header", True).partitionBy("landing").csv(src)
    landed = land_dated_files(spark, src, scratch_path(spark, "landed-orders"), "orders")
    return landed.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")) \
        .agg(F.count(F.lit(1)).alias("n"))


# files are dated the 1st, 8th, 15th or 22nd of the order's month
FILE_DAY_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(7 * ((day(o_orderdate) - 1) // 8) AS INTEGER)"


def _dated_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    week = F.floor((F.dayofmonth("o_orderdate") - 1) / 8).cast("int")
    return o.withColumn("day", F.date_add(F.trunc("o_orderdate", "month"), 7 * week))


def _drop_by_date(rows, src):
    """One CSV file per day, as ``orders_YYYY-MM-DD.csv``."""
    name = F.concat(F.lit("orders_"), F.date_format("day", "yyyy-MM-dd"), F.lit(".csv"))
    rows.withColumn("landing", name).drop("day").repartition("landing") \
        .write.option("header", True).partitionBy("landing").csv(src)


@register("land_daily_two_runs", f"""
SELECT {FILE_DAY_SQL} AS file_date, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkeys FROM orders GROUP BY 1""")
def land_daily_two_runs(spark, sf_dir):
    """The files of the 1st and 15th land first, then those of the 8th and 22nd
    and of the 1st once more: each is there once, beside the other days of its
    month."""
    o = _dated_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    day, dst = F.dayofmonth("day"), scratch_path(spark, "landed-daily")
    landed = None
    for days in ((1, 15), (1, 8, 22)):
        src = scratch_path(spark, "sftp-daily")
        _drop_by_date(o.filter(day.isin(*days)), src)
        landed = land_dated_files(spark, src, dst, "orders")
    return landed.groupBy(F.col("file_date").cast("date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_custkey").cast("long")).alias("custkeys"))


@register("land_reordered_header", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN day({FILE_DAY_SQL}) IN (8, 22) THEN o_orderstatus END AS status FROM orders""")
def land_reordered_header(spark, sf_dir):
    """The files of two of the four days have their columns in another order,
    and one more."""
    o = _dated_orders(spark, sf_dir)
    other, src = F.dayofmonth("day").isin(8, 22), scratch_path(spark, "sftp-headers")
    _drop_by_date(o.filter(~other).select("o_orderkey", "o_custkey", "day"), f"{src}/a")
    _drop_by_date(o.filter(other).select(F.col("o_orderstatus").alias("status"), "o_custkey", "o_orderkey", "day"), f"{src}/b")
    return land_dated_files(spark, src, scratch_path(spark, "landed-headers"), "orders").select("o_orderkey", "o_custkey", "status")


@register("land_quoted_breaks", f"""
SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'key' ELSE CAST(o_orderkey AS VARCHAR) END AS key,
       CASE WHEN o_orderkey % 97 = 0 THEN 'note'
            ELSE ' first, "' || CAST(o_custkey AS VARCHAR) || '"' || chr(10) || 'second; it''s' || chr(10) || chr(10) || 'last ' END AS note,
       {FILE_DAY_SQL} AS file_date FROM orders""")
def land_quoted_breaks(spark, sf_dir):
    """Notes with separators, quotes, blanks at the ends and line breaks, and
    records that equal their file's header."""
    o, k = _dated_orders(spark, sf_dir), F.col("o_orderkey")
    note = F.concat(F.lit(' first, "'), F.col("o_custkey").cast("string"), F.lit('"\nsecond; it\'s\n\nlast '))
    rows = o.select(F.when(k % 97 == 0, "key").otherwise(k.cast("string")).alias("key"),
                    F.when(k % 97 == 0, "note").otherwise(note).alias("note"), "day")
    name = F.concat(F.lit("orders_"), F.date_format("day", "yyyy-MM-dd"), F.lit(".csv"))
    src = scratch_path(spark, "sftp-quoted")
    rows.withColumn("landing", name).drop("day").repartition("landing").write.options(**CSV_QUOTING, header=True).partitionBy("landing").csv(src)
    landed = land_dated_files(spark, src, scratch_path(spark, "landed-quoted"), "orders")
    return landed.select("key", "note", F.col("file_date").cast("date").alias("file_date"))


@register("scd2_history", """
WITH daily AS (
  SELECT oid, d, o_orderstatus FROM (
    SELECT o_custkey AS oid, CAST(o_orderdate AS DATE) AS d, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
lagged AS (SELECT *, lag(o_orderstatus) OVER (PARTITION BY oid ORDER BY d) AS prev FROM daily),
versions AS (SELECT oid, o_orderstatus, d FROM lagged WHERE prev IS NULL OR prev <> o_orderstatus)
SELECT oid, o_orderstatus, d AS effective_from, lead(d) OVER (PARTITION BY oid ORDER BY d) AS effective_to,
       lead(d) OVER (PARTITION BY oid ORDER BY d) IS NULL AS is_current
FROM versions""")
def scd2_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("oid"), "o_orderstatus", "o_orderdate",
                                               "o_orderkey")
    return scd2(o, ["oid"], "o_orderdate", ["o_orderstatus"], order=["o_orderkey"])


# --- vessel facts over lineitem voyages --------------------------------------------

def voyage_reports(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    dest = F.concat(F.lit("  supplier#"), F.lpad((F.col("l_partkey") % 100 + 1).cast("string"), 9, "0"), F.lit(" "))
    return j.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("vessel_key"),
                    F.to_date("o_orderdate").alias("snapshot_date"), F.to_date("o_orderdate").alias("departure_date"),
                    F.to_date("l_shipdate").alias("arrival_date"), dest.alias("destination_port_name"))


def _port_names(spark, sf_dir):
    return ports(spark, sf_dir).select("port_key", "port_name")


VOYAGES_SQL = """snap AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey AS vessel_key, CAST(o.o_orderdate AS DATE) AS snapshot_date,
         CAST(o.o_orderdate AS DATE) AS departure_date, CAST(l.l_shipdate AS DATE) AS arrival_date,
         coalesce(s.s_suppkey, -1) AS destination_port_key
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON upper(s.s_name) = 'SUPPLIER#' || lpad(CAST(l.l_partkey % 100 + 1 AS VARCHAR), 9, '0'))"""


@register("vessel_snapshot", with_ctes(VOYAGES_SQL) + """
SELECT *, CAST(datediff('day', snapshot_date, arrival_date) AS INTEGER) AS days_to_arrival FROM snap""")
def vessel_snapshot_q(spark, sf_dir):
    return vessel_snapshot(voyage_reports(spark, sf_dir), _port_names(spark, sf_dir))


AS_OF = dt.date(1998, 8, 1)


@register("vessel_trip", with_ctes(VOYAGES_SQL) + """
, trips AS (
  SELECT vessel_key, departure_date, destination_port_key, count(*) AS n_snapshots,
         min(snapshot_date) AS first_snapshot_date,
         arg_min(arrival_date, (snapshot_date, l_orderkey, l_linenumber, arrival_date)) AS scheduled_arrival,
         arg_max(arrival_date, (snapshot_date, l_orderkey, l_linenumber, arrival_date)) AS actual_arrival
  FROM snap WHERE departure_date IS NOT NULL GROUP BY vessel_key, departure_date, destination_port_key)
SELECT *, CAST(datediff('day', departure_date, actual_arrival) * 24 AS BIGINT) AS trip_duration_hours,
       CAST(datediff('day', scheduled_arrival, actual_arrival) * 24 AS BIGINT) AS arrival_delay_hours,
       CASE WHEN actual_arrival <= DATE '1998-08-01' THEN 'COMPLETED' ELSE 'IN_TRANSIT' END AS trip_status
FROM trips""")
def vessel_trip_q(spark, sf_dir):
    snaps = vessel_snapshot(voyage_reports(spark, sf_dir), _port_names(spark, sf_dir))
    return vessel_trip(snaps, AS_OF, order=["l_orderkey", "l_linenumber"])


@register("vessel_trip_moving_eta", """
WITH r AS (
  SELECT o_custkey AS vessel_key, CASE WHEN l_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS departure_date,
         l_orderkey % 5 AS destination_port_key, CAST(o_orderdate AS DATE) + CAST(l_linenumber AS INTEGER) AS seen,
         CAST(o_orderdate AS DATE) + 20 + CAST(l_linenumber * 7 % 5 - 2 AS INTEGER) AS eta, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
w AS (SELECT *, first_value(eta) OVER t AS scheduled, last_value(eta) OVER t AS actual, row_number() OVER t AS n, count(*) OVER t AS total
  FROM r WHERE departure_date IS NOT NULL WINDOW t AS (
    PARTITION BY vessel_key, departure_date, destination_port_key ORDER BY seen, l_orderkey, l_linenumber
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT vessel_key, departure_date, destination_port_key, total AS n_snapshots, scheduled AS scheduled_arrival, actual AS actual_arrival,
       CAST((actual - scheduled) * 24 AS BIGINT) AS arrival_delay_hours,
       CASE WHEN actual <= DATE '1998-08-01' THEN 'COMPLETED' ELSE 'IN_TRANSIT' END AS trip_status
FROM w WHERE n = 1""")
def vessel_trip_moving_eta(spark, sf_dir):
    """Daily reports of a voyage whose expected arrival moves back and forth, so
    some vessels are early; every eleventh has no departure."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    k, line = F.col("l_orderkey"), F.col("l_linenumber").cast("int")
    reports = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(o, k == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("vessel_key"), F.when(k % 11 != 0, F.col("day")).alias("departure_date"),
        (k % 5).alias("destination_port_key"), F.date_add("day", line).alias("snapshot_date"),
        F.date_add("day", 20 + line * 7 % 5 - 2).alias("arrival_date"), "l_orderkey", "l_linenumber")
    return vessel_trip(reports, AS_OF, order=["l_orderkey", "l_linenumber"]).select(
        "vessel_key", "departure_date", "destination_port_key", "n_snapshots", "scheduled_arrival", "actual_arrival",
        "arrival_delay_hours", "trip_status")


@register("vessel_port_risk", FACT_CTE + ", " + VOYAGES_SQL + """
, latest AS (
  SELECT vessel_key, snapshot_date, destination_port_key FROM (
    SELECT *, row_number() OVER (PARTITION BY vessel_key
                                 ORDER BY snapshot_date DESC, l_orderkey DESC, l_linenumber DESC,
                                          destination_port_key DESC) AS rn
    FROM snap) WHERE rn = 1),
dated AS (
  SELECT f.PORT_KEY, f.RISK_LEVEL, CAST(q.time AS DATE) AS d FROM fact f JOIN quakes q
  ON f.EARTHQUAKE_KEY = CAST(q.unid AS VARCHAR)),
recent AS (
  SELECT PORT_KEY, max(CASE RISK_LEVEL WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END) AS sev
  FROM dated WHERE d >= (SELECT max(d) FROM dated) - 1 AND PORT_KEY <> -1 GROUP BY PORT_KEY),
lvl AS (SELECT PORT_KEY, CASE sev WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'NONE' END AS l
        FROM recent)
SELECT v.vessel_key, v.snapshot_date, v.destination_port_key, coalesce(lvl.l, 'NONE') AS port_risk_level,
       coalesce(lvl.l, 'NONE') IN ('HIGH', 'MEDIUM') AS is_heading_to_dangerous_port,
       coalesce(lvl.l, 'NONE') = 'HIGH' AS notification_required
FROM latest v LEFT JOIN lvl ON v.destination_port_key = lvl.PORT_KEY""")
def vessel_port_risk_q(spark, sf_dir):
    ensure_utc(spark)
    snaps = vessel_snapshot(voyage_reports(spark, sf_dir), _port_names(spark, sf_dir))
    fact = risk_fact(quakes(spark, sf_dir), ports(spark, sf_dir))
    return vessel_port_risk(snaps, fact, order=["l_orderkey", "l_linenumber"])



@register("scd2_snapshots", """
WITH snap AS (
  SELECT oid, s, o_orderstatus FROM (
    SELECT o_custkey AS oid, CAST(date_trunc('month', o_orderdate) AS DATE) AS s, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
cal AS (SELECT s, lag(s) OVER (ORDER BY s) AS gprev, lead(s) OVER (ORDER BY s) AS gnext
        FROM (SELECT DISTINCT s FROM snap)),
r AS (SELECT snap.*, cal.gprev, cal.gnext,
             lag(s) OVER (PARTITION BY oid ORDER BY s) AS ps,
             lag(o_orderstatus) OVER (PARTITION BY oid ORDER BY s) AS pv
      FROM snap JOIN cal USING (s)),
v AS (SELECT *, sum(CASE WHEN ps IS NULL OR ps <> gprev OR pv <> o_orderstatus THEN 1 ELSE 0 END)
                  OVER (PARTITION BY oid ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver
      FROM r),
g AS (SELECT oid, ver, min(s) AS effective_from, max(s) AS last_s, arg_min(o_orderstatus, s) AS o_orderstatus
      FROM v GROUP BY oid, ver)
SELECT g.oid, g.o_orderstatus, g.effective_from, cal.gnext AS effective_to, cal.gnext IS NULL AS is_current
FROM g JOIN cal ON cal.s = g.last_s""")
def scd2_snapshots(spark, sf_dir):
    """Monthly full snapshots of each customer's order status (latest order of
    the month); a customer missing from a month closes its version."""
    from quayside.operators.scd import scd2_from_snapshots

    o = table(spark, sf_dir, "orders")
    snaps = o.select(F.col("o_custkey").alias("oid"), F.trunc("o_orderdate", "month").alias("s"),
                     "o_orderstatus", "o_orderdate", "o_orderkey")
    return scd2_from_snapshots(snaps, ["oid"], "s", ["o_orderstatus"], order=["o_orderdate", "o_orderkey"])
