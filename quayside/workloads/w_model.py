"""Semantic-model workloads: dimensions, keys, measures, star and map views
(D1, P18, A9-A15, J5, J9, J10, U2, U3, A8, P17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.flags import add_communication_metrics, add_supply_metrics
from quayside.functions.keys import date_key, time_key
from quayside.operators.metrics import (average_expr, cross_filter, distinct_count_expr, distinct_where_expr,
                                        last_window_distinct, measures, star_join)
from quayside.plans.dims import dim_date
from quayside.plans.risk import risk_fact
from quayside.plans.views import fill_not_provided, location_map, location_map_detail
from quayside.session import ensure_utc
from quayside.workloads import register
from quayside.workloads.fixtures import PORTS_SQL, QUAKES_SQL, ports, quakes, table, with_ctes
from quayside.workloads.w_clean import PORT_FLAGS_SQL, port_flags, COMM_SUM, SUPPLY_SUM
from quayside.workloads.w_risk import BOX_CTES

FACT_CTE = with_ctes(QUAKES_SQL, PORTS_SQL, BOX_CTES) + """
, fact AS (
  SELECT CAST(q.unid AS VARCHAR) AS EARTHQUAKE_KEY, CAST(coalesce(a.port_key, -1) AS BIGINT) AS PORT_KEY,
         coalesce(a.distance_km, -1.0) AS DISTANCE_KM, coalesce(CAST(a.radius_km AS DOUBLE), -1.0) AS RISK_RADIUS_KM,
         coalesce(a.distance_km <= a.radius_km, false) AS IS_NEARBY, coalesce(a.impact_level, 'NONE') AS RISK_LEVEL,
         CAST(year(q.time) AS INTEGER) AS EVENT_YEAR, CAST(month(q.time) AS INTEGER) AS EVENT_MONTH
  FROM quakes q LEFT JOIN affected a ON q.unid = a.unid)
"""


def _fact(spark, sf_dir):
    ensure_utc(spark)
    return risk_fact(quakes(spark, sf_dir), ports(spark, sf_dir))


@register("dim_date", """
WITH days AS (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
  FROM events)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DATE_KEY, d AS FULL_DATE, CAST(day(d) AS INTEGER) AS DAY,
       CAST(month(d) AS INTEGER) AS MONTH, strftime(d, '%B') AS MONTH_NAME, CAST(quarter(d) AS INTEGER) AS QUARTER,
       CAST(year(d) AS INTEGER) AS YEAR, CAST(weekofyear(d) AS INTEGER) AS WEEK_OF_YEAR,
       CAST(isodow(d) AS INTEGER) AS DAY_OF_WEEK, strftime(d, '%A') AS DAY_NAME, isodow(d) >= 6 AS IS_WEEKEND
FROM days""")
def dim_date_q(spark, sf_dir):
    bounds = table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi")).first()
    return dim_date(spark, bounds["lo"], bounds["hi"])


@register("date_time_keys", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS TIME_DATE_KEY,
       CAST(strftime(ts, '%H%M%S') AS INTEGER) AS TIME_TIME_KEY,
       CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS EVENT_DATE_KEY
FROM events""")
def date_time_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", date_key("ts").alias("TIME_DATE_KEY"), time_key("ts").alias("TIME_TIME_KEY"),
                    date_key(F.to_date("ts")).alias("EVENT_DATE_KEY"))


@register("kpi_distinct", """
SELECT event_type, count(DISTINCT event_id) AS total_earthquakes, count(DISTINCT user_id) AS total_users
FROM events GROUP BY event_type""")
def kpi_distinct(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return measures(e, ["event_type"], total_earthquakes=distinct_count_expr("event_id"),
                    total_users=distinct_count_expr("user_id"))


@register("kpi_last_24h", """
WITH latest AS (SELECT event_type, max(ts) AS m FROM events GROUP BY event_type
                UNION ALL SELECT 'ALL', max(ts) FROM events)
SELECT l.event_type AS scope,
       (SELECT count(DISTINCT e.event_id) FROM events e
        WHERE e.ts >= l.m - INTERVAL 1 DAY AND e.ts <= l.m) AS earthquakes_last_24h
FROM latest l""")
def kpi_last_24h(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return last_window_distinct(e, e, "ts", "event_id", "earthquakes_last_24h", group_by=["event_type"], total="ALL") \
        .withColumnRenamed("event_type", "scope")


@register("kpi_filtered_distinct", FACT_CTE + """
SELECT EVENT_YEAR, EVENT_MONTH,
       count(DISTINCT CASE WHEN IS_NEARBY THEN PORT_KEY END) AS nearby_ports,
       count(DISTINCT CASE WHEN RISK_LEVEL = 'HIGH' THEN PORT_KEY END) AS high_risk_ports
FROM fact GROUP BY EVENT_YEAR, EVENT_MONTH""")
def kpi_filtered_distinct(spark, sf_dir):
    # a port once a month: two distinct counts would make three rows of every pair
    by = ["EVENT_YEAR", "EVENT_MONTH"]
    f = _fact(spark, sf_dir).groupBy(*by, "PORT_KEY").agg(
        F.max("IS_NEARBY").alias("IS_NEARBY"), F.max(F.col("RISK_LEVEL") == "HIGH").alias("IS_HIGH"))
    return measures(f, by, nearby_ports=distinct_where_expr("PORT_KEY", F.col("IS_NEARBY")),
                    high_risk_ports=distinct_where_expr("PORT_KEY", F.col("IS_HIGH")))


@register("kpi_averages", FACT_CTE + """
SELECT RISK_LEVEL, round(avg(DISTANCE_KM), 6) AS avg_distance_km,
       round(avg(CASE WHEN DISTANCE_KM <> -1.0 THEN DISTANCE_KM END), 6) AS avg_distance_km_matched
FROM fact GROUP BY RISK_LEVEL""")
def kpi_averages(spark, sf_dir):
    f = _fact(spark, sf_dir)
    return measures(f, ["RISK_LEVEL"],
                    avg_distance_km=F.round(average_expr("DISTANCE_KM"), 6),
                    avg_distance_km_matched=F.round(average_expr("DISTANCE_KM", exclude=-1.0), 6))


@register("kpi_port_ratings", with_ctes(PORT_FLAGS_SQL) + f"""
, rated AS (SELECT oid, CAST({SUPPLY_SUM} AS INTEGER) AS s, CAST({COMM_SUM} AS INTEGER) AS c FROM flags)
SELECT count(DISTINCT oid) AS total_ports,
       count(DISTINCT CASE WHEN s = 5 THEN oid END) AS excellent_supply_ports,
       count(DISTINCT CASE WHEN c = 4 THEN oid END) AS excellent_communication_ports
FROM rated""")
def kpi_port_ratings(spark, sf_dir):
    p = add_communication_metrics(add_supply_metrics(port_flags(spark, sf_dir)))
    return p.agg(
        F.countDistinct("oid").alias("total_ports"),
        F.countDistinct(F.when(F.col("supplies_rate") == "Excellent", F.col("oid"))).alias("excellent_supply_ports"),
        F.countDistinct(F.when(F.col("comm_rate") == "Excellent", F.col("oid"))).alias("excellent_communication_ports"))


@register("star_join", """
WITH li AS (
  SELECT l_orderkey,
         sum(CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(15, 2)))) AS rev
  FROM lineitem GROUP BY l_orderkey)
SELECT r.r_name, CAST(year(o.o_orderdate) AS INTEGER) AS o_year, CAST(round(sum(li.rev), 2) AS DOUBLE) AS revenue,
       count(*) AS n_orders
FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, year(o.o_orderdate)""")
def star_join_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # many lines per order: reduce to one row per order before joining orders.
    # Money is summed as exact decimals, so the total does not depend on the
    # order in which partitions are combined.
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    disc = F.col("l_discount").cast("decimal(15,2)")
    per_order = li.groupBy("l_orderkey").agg(F.sum(price * (1 - disc)).alias("rev"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    fact = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    joined = star_join(fact, [
        (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey"),
        (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), "c_nationkey", "n_nationkey"),
        (table(spark, sf_dir, "region").select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey"),
    ])
    return joined.groupBy("r_name", F.year("o_orderdate").cast("int").alias("o_year")).agg(
        F.round(F.sum("rev"), 2).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n_orders"))


@register("cross_filter", FACT_CTE + """
SELECT q.unid, q.mag, q.lat, q.lon FROM quakes q
WHERE EXISTS (SELECT 1 FROM fact f WHERE f.EARTHQUAKE_KEY = CAST(q.unid AS VARCHAR) AND f.RISK_LEVEL = 'HIGH')""")
def cross_filter_q(spark, sf_dir):
    q = quakes(spark, sf_dir).select("unid", "mag", "lat", "lon")
    high = _fact(spark, sf_dir).filter(F.col("RISK_LEVEL") == "HIGH").select(F.col("EARTHQUAKE_KEY"))
    return cross_filter(q.withColumn("EARTHQUAKE_KEY", F.col("unid").cast("string")), high, "EARTHQUAKE_KEY") \
        .drop("EARTHQUAKE_KEY")


# --- port dimension rows derived from supplier -------------------------------------

def port_dimension_rows(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = ports(spark, sf_dir).select("port_key", "port_latitude", "port_longitude")
    k = F.col("s_suppkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left") \
        .join(p, k == p.port_key)
    return j.select(
        k.alias("PORT_KEY"), F.col("s_name").alias("MAIN_PORT_NAME"),
        F.when(k % 3 != 0, F.concat(F.col("s_name"), F.lit(" Alt"))).alias("ALTERNATE_PORT_NAME"),
        F.when(k % 4 != 0, F.concat(F.lit("UN"), k.cast("string"))).alias("UN_LOCODE"),
        F.when(k % 5 != 0, F.col("n_name")).alias("COUNTRY_CODE"),
        F.when(k % 7 != 0, F.col("r_name")).alias("REGION_NAME"),
        F.when(k % 2 != 0, F.lit("Pacific Ocean")).alias("WORLD_WATER_BODY"),
        F.when(k % 6 == 1, F.lit("Area 1")).alias("IHO_S130_SEA_AREA"),
        F.col("port_latitude").alias("LATITUDE"), F.col("port_longitude").alias("LONGITUDE"),
        F.when(k % 3 == 0, "S").when(k % 3 == 1, "M").otherwise("L").alias("HARBOR_SIZE"),
        F.lit("CN").alias("HARBOR_TYPE"))


PORT_DIM_SQL = """port_dim AS (
  SELECT s.s_suppkey AS PORT_KEY, s.s_name AS MAIN_PORT_NAME,
         CASE WHEN s.s_suppkey % 3 <> 0 THEN s.s_name || ' Alt' END AS ALTERNATE_PORT_NAME,
         CASE WHEN s.s_suppkey % 4 <> 0 THEN 'UN' || CAST(s.s_suppkey AS VARCHAR) END AS UN_LOCODE,
         CASE WHEN s.s_suppkey % 5 <> 0 THEN n.n_name END AS COUNTRY_CODE,
         CASE WHEN s.s_suppkey % 7 <> 0 THEN r.r_name END AS REGION_NAME,
         CASE WHEN s.s_suppkey % 2 <> 0 THEN 'Pacific Ocean' END AS WORLD_WATER_BODY,
         CASE WHEN s.s_suppkey % 6 = 1 THEN 'Area 1' END AS IHO_S130_SEA_AREA,
         p.port_latitude AS LATITUDE, p.port_longitude AS LONGITUDE,
         CASE s.s_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE 'L' END AS HARBOR_SIZE,
         'CN' AS HARBOR_TYPE
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey JOIN ports p ON p.port_key = s.s_suppkey)"""


@register("fill_unknown", with_ctes(PORTS_SQL, PORT_DIM_SQL) + """
SELECT PORT_KEY, MAIN_PORT_NAME,
       coalesce(ALTERNATE_PORT_NAME, 'Not_Provided') AS ALTERNATE_PORT_NAME,
       coalesce(UN_LOCODE, 'Not_Provided') AS UN_LOCODE, coalesce(COUNTRY_CODE, 'Not_Provided') AS COUNTRY_CODE,
       coalesce(REGION_NAME, 'Not_Provided') AS REGION_NAME,
       coalesce(WORLD_WATER_BODY, 'Not_Provided') AS WORLD_WATER_BODY,
       coalesce(IHO_S130_SEA_AREA, 'Not_Provided') AS IHO_S130_SEA_AREA,
       LATITUDE, LONGITUDE, HARBOR_SIZE, HARBOR_TYPE
FROM port_dim""")
def fill_unknown_q(spark, sf_dir):
    return fill_not_provided(port_dimension_rows(spark, sf_dir))


@register("location_map", with_ctes(QUAKES_SQL, PORTS_SQL, PORT_DIM_SQL) + """
SELECT 'EARTHQUAKE' AS LOCATION_TYPE, CAST(unid AS VARCHAR) AS LOCATION_KEY, CAST(unid AS VARCHAR) AS LOCATION_NAME,
       lat AS LATITUDE, lon AS LONGITUDE, mag AS MAGNITUDE, depth AS DEPTH_KM, time AS EVENT_TIME,
       CAST(NULL AS BIGINT) AS PORT_KEY, CAST(unid AS VARCHAR) AS EARTHQUAKE_KEY FROM quakes
UNION ALL
SELECT 'PORT', CAST(PORT_KEY AS VARCHAR), MAIN_PORT_NAME, LATITUDE, LONGITUDE, NULL, NULL, NULL,
       PORT_KEY, NULL FROM port_dim""")
def location_map_q(spark, sf_dir):
    return location_map(quakes(spark, sf_dir), port_dimension_rows(spark, sf_dir))


@register("location_map_detail", FACT_CTE + ", " + PORT_DIM_SQL + """
, max_radius AS (SELECT EARTHQUAKE_KEY, max(RISK_RADIUS_KM) AS r FROM fact GROUP BY EARTHQUAKE_KEY)
SELECT 'EARTHQUAKE' AS LOCATION_TYPE, CAST(q.unid AS VARCHAR) AS LOCATION_KEY, CAST(q.unid AS VARCHAR) AS LOCATION_NAME,
       q.lat AS LATITUDE, q.lon AS LONGITUDE, q.mag AS MAGNITUDE, q.depth AS DEPTH_KM, q.time AS EVENT_TIME,
       coalesce(r.r, 5.0) AS RISK_RADIUS_KM, coalesce(r.r, 5.0) AS MAP_SIZE, CAST(NULL AS BIGINT) AS PORT_KEY,
       CAST(q.unid AS VARCHAR) AS EARTHQUAKE_KEY, q.flynn_region AS FLYNN_REGION, CAST(NULL AS VARCHAR) AS MAGTYPE,
       CAST(NULL AS VARCHAR) AS COUNTRY_CODE, CAST(NULL AS VARCHAR) AS REGION_NAME,
       CAST(NULL AS VARCHAR) AS HARBOR_SIZE, CAST(NULL AS VARCHAR) AS HARBOR_TYPE
FROM quakes q LEFT JOIN max_radius r ON CAST(q.unid AS VARCHAR) = r.EARTHQUAKE_KEY
UNION ALL
SELECT 'PORT', CAST(PORT_KEY AS VARCHAR), MAIN_PORT_NAME, LATITUDE, LONGITUDE, NULL, NULL, NULL, 5.0, 5.0,
       PORT_KEY, NULL, NULL, NULL, COUNTRY_CODE, REGION_NAME, HARBOR_SIZE, HARBOR_TYPE
FROM port_dim""")
def location_map_detail_q(spark, sf_dir):
    q = quakes(spark, sf_dir).withColumn("magtype", F.lit(None).cast("string"))
    return location_map_detail(q, _fact(spark, sf_dir), port_dimension_rows(spark, sf_dir))


@register("quake_calendar", """
WITH days AS (
  SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
  FROM events),
dd AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DATE_KEY, d AS FULL_DATE, strftime(d, '%A') AS DAY_NAME,
              isodow(d) >= 6 AS IS_WEEKEND FROM days),
dt AS (SELECT CAST((s // 3600) * 10000 + ((s % 3600) // 60) * 100 + s % 60 AS INTEGER) AS TIME_KEY,
              CAST(s // 3600 AS INTEGER) AS HOUR, CAST((s % 3600) // 60 AS INTEGER) AS MINUTE,
              printf('%02d:%02d', s // 3600, (s % 3600) // 60) AS HOUR_MINUTE
       FROM (SELECT range AS s FROM range(86400))),
e AS (SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS TIME_DATE_KEY,
             CAST(strftime(ts, '%H%M%S') AS INTEGER) AS TIME_TIME_KEY FROM events)
SELECT e.event_id, dd.FULL_DATE, dd.DAY_NAME, dd.IS_WEEKEND, dt.HOUR, dt.MINUTE, dt.HOUR_MINUTE
FROM e LEFT JOIN dd ON e.TIME_DATE_KEY = dd.DATE_KEY LEFT JOIN dt ON e.TIME_TIME_KEY = dt.TIME_KEY""")
def quake_calendar(spark, sf_dir):
    """Quakes against DIM_DATE and DIM_TIME through their integer keys (the
    model's quake->date and quake->time relationships)."""
    from quayside.plans.dims import dim_time

    e = table(spark, sf_dir, "events")
    bounds = e.agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi")).first()
    keyed = e.select("event_id", date_key("ts").alias("TIME_DATE_KEY"), time_key("ts").alias("TIME_TIME_KEY"))
    out = star_join(keyed, [(dim_date(spark, bounds["lo"], bounds["hi"]), "TIME_DATE_KEY", "DATE_KEY"),
                            (dim_time(spark), "TIME_TIME_KEY", "TIME_KEY")])
    return out.select("event_id", "FULL_DATE", "DAY_NAME", "IS_WEEKEND", "HOUR", "MINUTE", "HOUR_MINUTE")


@register("kpi_port_depths", """
SELECT count(DISTINCT p_partkey) AS total_ports,
       round(avg(CASE WHEN p_partkey % 8 IN (0, 1) THEN NULL ELSE CAST(p_size AS DOUBLE) END), 6)
         AS average_channel_depth,
       round(avg(p_size * 1.5), 6) AS average_maximum_vessel_draft
FROM part""")
def kpi_port_depths(spark, sf_dir):
    """Total ports and the two depth averages (NULL depths ignored)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ports_ = p.select(k.alias("port_key"),
                      F.when(~(k % 8).isin(0, 1), F.col("p_size").cast("double")).alias("channel_depth_m"),
                      (F.col("p_size") * 1.5).alias("maximum_vessel_draft_m"))
    # the three measures in one aggregate pass over the table
    return ports_.agg(
        F.countDistinct("port_key").cast("bigint").alias("total_ports"),
        F.round(F.avg("channel_depth_m"), 6).alias("average_channel_depth"),
        F.round(F.avg("maximum_vessel_draft_m"), 6).alias("average_maximum_vessel_draft"))
