"""Page-extraction workloads.

Listing pages are built by Spark from ``supplier`` (20 vessels per page,
with header rows, short rows and rows without a link), detail pages from
``orders`` (with missing blocks and link-less variants) and port pages from
``supplier``; the oracle computes the expected records from the same tables.
The driver's ``pages`` are scanned whole for pagination.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators.clean import cast_to_spec, conform, exclude_containing, null_tokens, trim_strings
from quayside.sources.html import extract_listing_rows, extract_total_pages, extract_vessel_details, \
    with_port_coordinates
from quayside.workloads import register
from quayside.workloads.fixtures import PORTS_SQL, ports, table, with_ctes

SITE = "https://vessels.example.org"
AS_OF_YEAR = 2026
ROWS_PER_PAGE = 20


def listing_pages(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    k = F.col("s_suppkey")
    vtype = F.when(k % 4 == 0, "Bulk Carrier").when(k % 4 == 1, "Water Tanker") \
        .when(k % 4 == 2, "Container Ship").otherwise("")
    anchor = F.when(vtype == "", F.col("s_name")).otherwise(F.concat(F.col("s_name"), F.lit("\n"), vtype))
    link = F.when(k % 5 == 0, F.concat(F.lit("https://other.example.com/v/"), k.cast("string"))) \
        .otherwise(F.concat(F.lit("/vessels/details/"), k.cast("string")))
    year = F.when(k % 11 == 0, F.lit("")).otherwise((1990 + k % 30).cast("string"))
    size = F.when(k % 3 == 0, F.lit("")) \
        .when(k % 3 == 1, F.concat((k % 300).cast("string"), F.lit(" / "), (k % 40).cast("string"))) \
        .otherwise((k % 300).cast("string"))
    first = F.concat(F.lit('<td><a href="'), link, F.lit('">'), anchor, F.lit("</a></td>"))
    rest = F.concat(F.lit("<td> "), year, F.lit(" </td><td>"), (k * 100).cast("string"), F.lit("</td><td>"),
                    (k * 150).cast("string"), F.lit("</td><td>"), size, F.lit("</td>"))
    row = (F.when(k % 13 == 0, F.concat(F.lit("<tr>"), first, F.lit("<td>x</td><td>y</td></tr>")))
           .when(k % 17 == 0, F.concat(F.lit("<tr><td>"), F.col("s_name"), F.lit("</td>"), rest, F.lit("</tr>")))
           .otherwise(F.concat(F.lit("<tr>"), first, rest, F.lit("</tr>"))))
    page = (F.floor((k - 1) / ROWS_PER_PAGE) + 1).cast("bigint")
    # one group per page of 20 rows: bounded
    grouped = s.select(page.alias("page_id"), k.alias("k"), row.alias("row")).groupBy("page_id") \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "row"))), lambda x: x["row"]), "")
             .alias("rows"))
    # the page count is one value: resolved first, used as a literal
    n_pages = s.agg(F.max(page).alias("n")).first()["n"]
    html = F.concat(
        F.lit('<html><body><h1>Vessels</h1><table class="results"><tr><th>Vessel</th><th>Built</th><th>GT</th>'
              '<th>DWT</th><th>Size</th></tr>'), F.col("rows"),
        F.lit('</table><div class="pg">Page '), F.col("page_id").cast("string"), F.lit(" of "),
        F.lit(str(n_pages)), F.lit("</div></body></html>"))
    return grouped.select("page_id", html.alias("html"))


LISTING_EXPECTED_SQL = f"""
SELECT CAST(floor((s_suppkey - 1) / {ROWS_PER_PAGE}) + 1 AS BIGINT) AS page_id, s_name AS name,
       CASE s_suppkey % 4 WHEN 0 THEN 'Bulk Carrier' WHEN 1 THEN 'Water Tanker' WHEN 2 THEN 'Container Ship'
            ELSE 'Cargo' END AS type,
       CASE WHEN s_suppkey % 11 = 0 THEN '-' ELSE CAST(1990 + s_suppkey % 30 AS VARCHAR) END AS year_built,
       CAST(s_suppkey * 100 AS VARCHAR) AS gross_tonnage, CAST(s_suppkey * 150 AS VARCHAR) AS deadweight,
       CASE WHEN s_suppkey % 3 = 0 THEN '-' ELSE CAST(s_suppkey % 300 AS VARCHAR) END AS length_m,
       CASE WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey % 40 AS VARCHAR) ELSE '-' END AS beam_m,
       CASE WHEN s_suppkey % 5 = 0 THEN 'https://other.example.com/v/' || CAST(s_suppkey AS VARCHAR)
            ELSE '{SITE}/vessels/details/' || CAST(s_suppkey AS VARCHAR) END AS detail_link
FROM supplier WHERE s_suppkey % 13 <> 0 AND s_suppkey % 17 <> 0"""


@register("listing_rows", LISTING_EXPECTED_SQL)
def listing_rows(spark, sf_dir):
    rows = extract_listing_rows(listing_pages(spark, sf_dir), keep=["page_id"], default_type="Cargo",
                                base_url=SITE)
    return rows.drop("row_pos")


def _pages_sql(html):
    return (f"coalesce(TRY_CAST(nullif(regexp_extract({html}, '(?i)page\\s*1\\s*/\\s*(\\d+)', 1), '') AS INTEGER), "
            f"TRY_CAST(nullif(regexp_extract({html}, '(?i)Page\\s*1\\s*of\\s*(\\d+)', 1), '') AS INTEGER), "
            f"TRY_CAST(nullif(regexp_extract({html}, '(?i)1\\s*-\\s*\\d+\\s*of\\s*\\d+\\s*\\(\\s*(\\d+)\\s*pages?\\)', 1), '')"
            f" AS INTEGER), 1)")


@register("total_pages", f"""
SELECT 'pages' AS source, page_id, {_pages_sql('html')} AS total_pages FROM pages
UNION ALL
SELECT 'listing', p, CASE WHEN p = 1 THEN CAST(n AS INTEGER) ELSE 1 END
FROM (SELECT DISTINCT CAST(floor((s_suppkey - 1) / {ROWS_PER_PAGE}) + 1 AS BIGINT) AS p FROM supplier),
     (SELECT max(CAST(floor((s_suppkey - 1) / {ROWS_PER_PAGE}) + 1 AS BIGINT)) AS n FROM supplier)""")
def total_pages(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), "page_id", "html")
    lst = listing_pages(spark, sf_dir).select(F.lit("listing").alias("source"), "page_id", "html")
    both = pg.unionByName(lst)
    return both.select("source", "page_id", extract_total_pages("html").alias("total_pages"))


# --- detail and port pages ----------------------------------------------------------

STATUS = {"F": "Moored", "O": "Under way using engine", "P": "At anchor"}


def detail_pages(spark, sf_dir, destinations=30):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n2 = n.select(F.col("n_nationkey").alias("d_nationkey"), F.col("n_name").alias("d_name"))
    k = F.col("o_orderkey")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
         .join(n2, (k % 25) == F.col("d_nationkey")))
    dep_port = F.concat(F.lit("PORT"), (F.col("o_custkey") % 50).cast("string"))
    dep_text = F.concat(dep_port, F.lit(", "), F.col("n_name"))
    atd = F.concat(F.lit("ATD: "), F.date_format("o_orderdate", "MMM d, yyyy HH:mm"))
    dep = (F.when(k % 7 == 0, F.lit(""))
           .when(k % 3 == 1, F.concat(F.lit('<div class="vi__r1 vi__stp"><div>Departure</div><div>'), dep_text,
                                      F.lit("</div></div>")))
           .otherwise(F.concat(F.lit('<div class="vi__r1 vi__stp"><a class="_npNa" href="/ports/'), dep_port,
                               F.lit('">'), dep_text, F.lit("</a><div>Departure</div><div>"), atd,
                               F.lit("</div></div>"))))
    dest_port = F.concat(F.lit("DEST"), (k % destinations).cast("string"))
    dest_text = F.concat(dest_port, F.lit(", "), F.col("d_name"))
    eta = F.concat(F.lit("ETA: "), F.date_format(F.date_add(F.to_date("o_orderdate"), 10), "MMM d HH:mm"))
    dst = (F.when(k % 5 == 0, F.concat(F.lit('<div class="vi__r1 vi__sbt"><div>Destination</div><div>'), dest_text,
                                       F.lit("</div></div>")))
           .otherwise(F.concat(F.lit('<div class="vi__r1 vi__sbt"><a class="_npNa" href="/ports/'), dest_port,
                               F.lit('">'), dest_text, F.lit("</a><div>Destination</div><div>"), eta,
                               F.lit("</div></div>"))))
    status = F.when(F.col("o_orderstatus") == "F", STATUS["F"]).when(F.col("o_orderstatus") == "O", STATUS["O"]) \
        .otherwise(STATUS["P"])
    tbl = F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(
        F.lit("<table><tr><td>Navigation Status</td><td>"), status, F.lit("</td></tr><tr><td>Position Received"
              '</td><td><svg class="ttt1 info" data-title="'), F.date_format("o_orderdate", "MMM d, yyyy HH:mm"),
        F.lit('"></svg></td></tr></table>')))
    html = F.concat(F.lit("<html><body><h1>Vessel</h1>"), dep, dst, tbl, F.lit("</body></html>"))
    # the join output is small in bytes, so AQE would pack it into one or two
    # partitions; the pages are CPU-heavy to parse, so spread them (fetched
    # pages read from files arrive spread over file splits anyway)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return j.select(k.alias("page_id"), html.alias("html")).repartition(n, "page_id")


def port_pages(spark, sf_dir):
    p = ports(spark, sf_dir)
    idx = (F.col("port_key") - 1).cast("string")
    lat = F.format_string("%.4f%s", F.abs("port_latitude"), F.when(F.col("port_latitude") < 0, "S").otherwise("N"))
    lon = F.format_string("%.4f%s", F.abs("port_longitude"), F.when(F.col("port_longitude") < 0, "W").otherwise("E"))
    html = F.concat(F.lit("<html><body><p>DEST"), idx, F.lit(" is located in the region at "), lat, F.lit(", "),
                    lon, F.lit(".</p></body></html>"))
    return p.select(F.concat(F.lit(SITE + "/ports/DEST"), idx).alias("url"), html.alias("html"))


PAGE_DETAILS_SQL = with_ctes(PORTS_SQL) + f"""
, o AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_orderdate, n.n_name, d.n_name AS d_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN nation d ON d.n_nationkey = o.o_orderkey % 25),
pp AS (
  SELECT port_key - 1 AS idx,
         printf('%.4f%s', abs(port_latitude), CASE WHEN port_latitude < 0 THEN 'S' ELSE 'N' END) AS lat_text,
         printf('%.4f%s', abs(port_longitude), CASE WHEN port_longitude < 0 THEN 'W' ELSE 'E' END) AS lon_text
  FROM ports)
SELECT k AS page_id,
  CASE WHEN k % 7 = 0 OR k % 3 = 1 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS departure_date,
  CASE WHEN k % 7 = 0 THEN '' ELSE n_name END AS last_port_country,
  CASE WHEN k % 7 = 0 THEN '' ELSE 'PORT' || CAST(o_custkey % 50 AS VARCHAR) END AS last_port_name,
  CASE WHEN k % 5 = 0 THEN '' ELSE '{AS_OF_YEAR}-' || strftime(CAST(o_orderdate AS DATE) + 10, '%m-%d') || ' 00:00'
  END AS arrival_date,
  d_name AS destination_port_country,
  'DEST' || CAST(k % 30 AS VARCHAR) AS destination_port_name,
  CASE WHEN k % 5 = 0 THEN '' ELSE '{SITE}/ports/DEST' || CAST(k % 30 AS VARCHAR) END AS destination_link,
  CASE WHEN k % 9 = 0 THEN '' WHEN o_orderstatus = 'F' THEN 'Moored'
       WHEN o_orderstatus = 'O' THEN 'Under way using engine' ELSE 'At anchor' END AS reported_status,
  CASE WHEN k % 9 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS report_date,
  CASE WHEN k % 5 = 0 THEN '' ELSE coalesce(pp.lat_text, '') END AS destination_port_lat,
  CASE WHEN k % 5 = 0 THEN '' ELSE coalesce(pp.lon_text, '') END AS destination_port_lon
FROM o LEFT JOIN pp ON pp.idx = o.k % 30"""


ALL_PORTS_SQL = PAGE_DETAILS_SQL.replace("n.n_name, d.n_name", "n.n_name, (SELECT count(*) FROM ports) AS np, d.n_name") \
    .replace("k % 30", "k % np").replace("SELECT k AS page_id,", "SELECT k AS page_id, CAST(NULL AS VARCHAR) AS error,")


@register("page_details", ALL_PORTS_SQL)
def page_details(spark, sf_dir):
    """Destinations go over all ports there are; every fifth is named without a link."""
    details = extract_vessel_details(detail_pages(spark, sf_dir, ports(spark, sf_dir).count()), keep=["page_id"],
                                     as_of_year=AS_OF_YEAR, base_url=SITE)
    return with_port_coordinates(details, port_pages(spark, sf_dir))


# the name under which the form over all ports was first registered
register("page_details_all_ports", ALL_PORTS_SQL)(page_details)


DETAIL_FIELDS = ["departure_date", "last_port_country", "last_port_name", "arrival_date", "destination_port_country", "destination_port_name",
                 "destination_link", "reported_status", "report_date", "destination_port_lat", "destination_port_lon"]


def odd_markup(html, k):
    """The same page in other markup, by page: single quotes; other case, order
    and spacing of names; bare attributes; a comment with a block and a nested
    table; no page at all."""
    def swap(c, *pairs):
        for a, b in pairs:
            c = F.replace(c, F.lit(a), F.lit(b))
        return c

    spread = swap(html, ('<div class="vi__r1 vi__stp">', '<DIV data-note="a > b" class=" vi__stp  new vi__r1">'),
                  ('<div class="vi__r1 vi__sbt">', "<Div class='vi__sbt vi__r1' id=d>"), ("</div>", "</DIV >"), ("<td>", "<TD align='left'>"))
    bare = F.regexp_replace(html, '<a class="_npNa" href="([^"]*)">', "<a title=\"class='x' href='/no'\" href=$1 class=_npNa>")
    nested = F.concat(F.lit('<!-- <div class="vi__r1 vi__sbt"><a class="_npNa" href="/ports/NONE">NONE, X</a></div> -->'),
                      swap(html, ("<table>", "<table><tr><td><table><tr><td>inner</td></tr></table></td></tr>"),
                           ("<div>Destination</div>", "<div><span>Desti</span>nation</div>")))
    return F.when(k % 6 == 1, F.replace(html, F.lit('"'), F.lit("'"))).when(k % 6 == 2, spread).when(k % 6 == 3, bare) \
        .when(k % 6 == 4, nested).when(k % 6 == 5, F.lit(None).cast("string")).otherwise(html)


@register("page_details_odd", f"""
SELECT page_id, CASE WHEN page_id % 6 = 5 THEN 'empty page' END AS error,
       {', '.join(f"CASE WHEN page_id % 6 = 5 THEN '' ELSE {c} END AS {c}" for c in DETAIL_FIELDS)}
FROM ({ALL_PORTS_SQL})""")
def page_details_odd(spark, sf_dir):
    pages = detail_pages(spark, sf_dir, ports(spark, sf_dir).count())
    pages = pages.withColumn("html", odd_markup(F.col("html"), F.col("page_id")))
    details = extract_vessel_details(pages, keep=["page_id"], as_of_year=AS_OF_YEAR, base_url=SITE)
    return with_port_coordinates(details, port_pages(spark, sf_dir))


@register("listing_rows_odd", LISTING_EXPECTED_SQL)
def listing_rows_odd(spark, sf_dir):
    """Listing pages with other quotes and case, row and cell ends left out, and
    a nested table in each fourth cell."""
    html, k = F.col("html"), F.col("page_id")
    bare = F.regexp_replace(F.replace(F.replace(html, F.lit("</td>"), F.lit("")), F.lit("</tr>"), F.lit("")), '<a href="([^"]*)">', "<A class='n' HREF='$1'>")
    nested = F.regexp_replace(F.replace(html, F.lit("<tr>"), F.lit("<tr class='<td>'><!--<td>-->")), "<td>([0-9]+50|[0-9]+00)</td>",
                              "<td><table><tr><td>$1</td></tr></table></td>")
    pages = listing_pages(spark, sf_dir).withColumn("html", F.when(k % 3 == 0, html).when(k % 3 == 1, bare).otherwise(nested))
    return extract_listing_rows(pages, keep=["page_id"], default_type="Cargo", base_url=SITE).drop("row_pos")


# --- vessel rows to the typed vessel table ------------------------------------------

VESSEL_COLUMNS = ["name", "type", "year_built", "gross_tonnage", "deadweight", "length_m", "beam_m", "detail_link",
                  "departure_date", "last_port_country", "last_port_name", "arrival_date",
                  "destination_port_country", "destination_port_name", "destination_port_lat",
                  "destination_port_lon", "reported_status", "report_date"]
VESSEL_TYPES = {"year_built": "int", "gross_tonnage": "bigint", "deadweight": "bigint", "length_m": "double",
                "beam_m": "double", "departure_date": "timestamp_ntz", "arrival_date": "timestamp_ntz",
                "destination_port_lat": "double", "destination_port_lon": "double", "report_date": "timestamp_ntz"}
VESSEL_FORMATS = {c: "yyyy-MM-dd HH:mm" for c in ("departure_date", "arrival_date", "report_date")}


@register("vessel_silver", f"""
SELECT s_name AS name,
       CASE s_suppkey % 4 WHEN 0 THEN 'Bulk Carrier' WHEN 2 THEN 'Container Ship' ELSE 'Cargo' END AS type,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(1990 + s_suppkey % 30 AS INTEGER) END AS year_built,
       CAST(s_suppkey * 100 AS BIGINT) AS gross_tonnage, CAST(s_suppkey * 150 AS BIGINT) AS deadweight,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey % 300 AS DOUBLE) END AS length_m,
       CASE WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey % 40 AS DOUBLE) END AS beam_m,
       CASE WHEN s_suppkey % 5 = 0 THEN 'https://other.example.com/v/' || CAST(s_suppkey AS VARCHAR)
            ELSE '{SITE}/vessels/details/' || CAST(s_suppkey AS VARCHAR) END AS detail_link,
       CAST(NULL AS TIMESTAMP) AS departure_date, CAST(NULL AS VARCHAR) AS last_port_country,
       CAST(NULL AS VARCHAR) AS last_port_name, CAST(NULL AS TIMESTAMP) AS arrival_date,
       CAST(NULL AS VARCHAR) AS destination_port_country, CAST(NULL AS VARCHAR) AS destination_port_name,
       CAST(NULL AS DOUBLE) AS destination_port_lat, CAST(NULL AS DOUBLE) AS destination_port_lon,
       CAST(NULL AS VARCHAR) AS reported_status, CAST(NULL AS TIMESTAMP) AS report_date
FROM supplier WHERE s_suppkey % 13 <> 0 AND s_suppkey % 17 <> 0 AND s_suppkey % 4 <> 1""")
def vessel_silver(spark, sf_dir):
    """Scraped listing rows conformed to the 18 vessel columns (absent ones
    filled with ""), water tankers excluded, placeholders to NULL, typed."""
    rows = extract_listing_rows(listing_pages(spark, sf_dir), default_type="Cargo", base_url=SITE).drop("row_pos")
    conformed = conform(rows, VESSEL_COLUMNS, missing="fill", fill="")
    kept = exclude_containing(conformed, "type", "Water Tanker")
    cleaned = trim_strings(null_tokens(kept, VESSEL_COLUMNS, ["-", "", "Destination not available"]))
    return cast_to_spec(cleaned, VESSEL_TYPES, VESSEL_FORMATS)
