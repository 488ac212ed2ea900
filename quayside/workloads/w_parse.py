"""Scraped-value parsing workloads (X12-X17, F7) over strings derived from
the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.parse import absolute_url, parse_coordinate, parse_eta, split_port, split_size
from quayside.operators.clean import exclude_containing, null_tokens
from quayside.workloads import register
from quayside.workloads.fixtures import PORTS_SQL, ports, table, with_ctes

AS_OF_YEAR = 2026
SITE = "https://vessels.example.org"


def eta_strings(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (F.when(k % 4 == 0, F.concat(F.lit("ETA: "), F.date_format(d, "MMM d, yyyy HH:mm")))
           .when(k % 4 == 1, F.date_format(d, "MMM d HH:mm"))
           .when(k % 4 == 2, F.concat(F.lit("Arrived "), F.date_format(d, "MMM d, yyyy, HH:mm")))
           .otherwise(F.concat(F.lit("Foo "), F.date_format(d, "d, yyyy HH:mm"))))
    return o.select("o_orderkey", raw.alias("eta_raw"))


@register("parse_eta", f"""
SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN 'ETA: ' || strftime(o_orderdate, '%b %-d, %Y %H:%M')
                      WHEN 1 THEN strftime(o_orderdate, '%b %-d %H:%M')
                      WHEN 2 THEN 'Arrived ' || strftime(o_orderdate, '%b %-d, %Y, %H:%M')
                      ELSE 'Foo ' || strftime(o_orderdate, '%-d, %Y %H:%M') END AS eta_raw,
  CASE o_orderkey % 4 WHEN 1 THEN '{AS_OF_YEAR}-' || strftime(o_orderdate, '%m-%d %H:%M')
                      WHEN 3 THEN ''
                      ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS eta
FROM orders""")
def parse_eta_q(spark, sf_dir):
    return eta_strings(spark, sf_dir).withColumn("eta", parse_eta("eta_raw", AS_OF_YEAR))


@register("parse_coordinate", with_ctes(PORTS_SQL) + """
, txt AS (
  SELECT port_key,
    CASE WHEN port_key % 9 = 0 THEN 'bad' WHEN port_key % 9 = 1 THEN '95.0000N'
         ELSE printf('%.4f%s', abs(port_latitude), CASE WHEN port_latitude < 0 THEN 'S' ELSE 'N' END) END AS lat_text,
    printf('%.4f%s', abs(port_longitude), CASE WHEN port_longitude < 0 THEN 'W' ELSE 'E' END) AS lon_text,
    port_latitude, port_longitude
  FROM ports)
SELECT port_key, lat_text, lon_text,
       CASE WHEN port_key % 9 IN (0, 1) THEN NULL ELSE port_latitude END AS lat,
       port_longitude AS lon
FROM txt""")
def parse_coordinate_q(spark, sf_dir):
    p = ports(spark, sf_dir)
    k = F.col("port_key")

    def hemi(v, neg, pos):
        return F.format_string("%.4f%s", F.abs(v), F.when(v < 0, F.lit(neg)).otherwise(F.lit(pos)))

    lat_text = (F.when(k % 9 == 0, F.lit("bad")).when(k % 9 == 1, F.lit("95.0000N"))
                .otherwise(hemi(F.col("port_latitude"), "S", "N")))
    t = p.select("port_key", lat_text.alias("lat_text"), hemi(F.col("port_longitude"), "W", "E").alias("lon_text"))
    return t.select("port_key", "lat_text", "lon_text",
                    parse_coordinate("lat_text").alias("lat"), parse_coordinate("lon_text").alias("lon"))


@register("split_size", """
SELECT p_partkey, size_text,
  CASE p_partkey % 3 WHEN 0 THEN CAST(p_size * 10 AS VARCHAR) WHEN 1 THEN CAST(p_size * 10 AS VARCHAR) ELSE '-' END AS length_m,
  CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) ELSE '-' END AS beam_m
FROM (SELECT p_partkey, p_size,
        CASE p_partkey % 3 WHEN 0 THEN CAST(p_size * 10 AS VARCHAR) || ' / ' || CAST(p_size AS VARCHAR)
                           WHEN 1 THEN CAST(p_size * 10 AS VARCHAR) ELSE '' END AS size_text FROM part)""")
def split_size_q(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    txt = (F.when(k % 3 == 0, F.concat((s * 10).cast("string"), F.lit(" / "), s.cast("string")))
           .when(k % 3 == 1, (s * 10).cast("string")).otherwise(F.lit("")))
    return p.select("p_partkey", txt.alias("size_text")).withColumns(split_size("size_text"))


@register("split_port", """
SELECT c_custkey, dest, trim(split_part(dest, ',', 1)) AS port_name,
       CASE WHEN c_custkey % 4 = 0 THEN '' ELSE n_name END AS port_country
FROM (SELECT c_custkey, n_name,
        CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_name || ', ' || n_name END AS dest
      FROM customer JOIN nation ON c_nationkey = n_nationkey)""")
def split_port_q(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dest = F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")) \
        .otherwise(F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")))
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", dest.alias("dest"))
    return j.withColumns(split_port("dest"))


@register("absolute_url", f"""
SELECT page_id, pos, href,
       CASE WHEN starts_with(href, '/') THEN '{SITE}' || href ELSE href END AS url
FROM (SELECT page_id, unnest(generate_series(1, len(hrefs))) AS pos, unnest(hrefs) AS href
      FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages))""")
def absolute_url_q(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", "html")
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    ex = pg.select("page_id", F.posexplode(hrefs).alias("pos0", "href"))
    return ex.select("page_id", (F.col("pos0") + 1).cast("bigint").alias("pos"), "href",
                     absolute_url("href", SITE).alias("url"))


@register("null_tokens", """
SELECT c_custkey, CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN NULL ELSE c_mktsegment END AS segment
FROM customer""")
def null_tokens_q(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = (F.when(k % 5 == 0, F.lit("-")).when(k % 5 == 1, F.lit("Destination not available"))
           .when(k % 5 == 2, F.lit("")).otherwise(F.col("c_mktsegment")))
    df = c.select("c_custkey", seg.alias("segment"))
    return null_tokens(df, ["segment"], ["-", "", "Destination not available"])


@register("exclude_containing", """
SELECT p_partkey, p_type FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_type END AS p_type FROM part)
WHERE p_type IS NULL OR NOT (lower(p_type) LIKE '%brushed%')""")
def exclude_containing_q(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    t = F.when(F.col("p_partkey") % 10 != 0, F.col("p_type"))
    return exclude_containing(p.select("p_partkey", t.alias("p_type")), "p_type", "Brushed")
