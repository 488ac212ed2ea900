"""Structured records from vessel listing, detail and port pages
(S11-S14, X12-X16).

Crawling is out of scope; these work on a table of already fetched pages
``(page_id, url, html)`` and run as ordinary Spark jobs over the array of a
page's tag events (:mod:`quayside.sources.markup`), all inside the JVM. A
page that does not have the expected structure yields blanks and an
``error``, never a failed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.dedupe import dedupe

from quayside.functions.parse import absolute_url, eta_from_matches, eta_matches, split_size
from quayside.sources.markup import (EVENT, attribute, between, closes, decode_entities, end_of, first, let, opens, page_events, step,
                                     strings, text_of, with_table_depth)

# Total-page patterns tried in order (case-insensitive), default 1
TOTAL_PAGE_PATTERNS = [
    r"page\s*1\s*/\s*(\d+)",
    r"Page\s*1\s*of\s*(\d+)",
    r"1\s*-\s*\d+\s*of\s*\d+\s*\(\s*(\d+)\s*pages?\)",
]
# Markers of the detail-page blocks
DEPARTURE_BLOCK = "vi__r1 vi__stp"
DESTINATION_BLOCK = "vi__r1 vi__sbt"
PORT_LINK_CLASS = "_npNa"
REPORT_ICON_CLASS = "ttt1 info"
STATUS_LABEL = "Navigation Status"
PLACEHOLDER = "-"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def html_text(c) -> Column:
    """Tag-stripped text with the common entities decoded."""
    return decode_entities(F.regexp_replace(_c(c), r"(?s)<[^>]*>", ""))


def extract_total_pages(c) -> Column:
    """First matching pagination pattern in the page's text, else 1."""
    s = html_text(_c(c))
    found = [F.when(s.rlike("(?i)" + p), F.regexp_extract(s, "(?i)" + p, 1).try_cast("int"))
             for p in TOTAL_PAGE_PATTERNS]
    return F.coalesce(*found, F.lit(1))


def extract_listing_rows(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None,
                         default_type: str | Column = "", base_url: str = "") -> DataFrame:
    """Rows of the first ``<table>`` of each page: one output row per ``<tr>``
    with at least five cells whose first cell holds a link. Rows of a table
    nested in it are rows too; the cells of a row are those of its own table."""
    keep = keep or []
    dtype = default_type if isinstance(default_type, Column) else F.lit(default_type)
    df = page_events(pages.select(*keep, dtype.alias("_dtype"), F.col(html_col).alias("_html")), [*keep, "_dtype"], "_html")
    ev, held = F.col("ev"), [*keep, "_dtype"]
    df = step(df, [*held, "ev"], _table=first(ev, opens("table"))["p"])
    df = step(df, held, _in=between(with_table_depth(ev), F.col("_table"), end_of(ev, F.col("_table"), "table")))

    def row(tr: Column) -> Column:
        """Events of a row, its own tag first, up to the end of the row."""
        end = first(F.col("_in"), lambda e: (e["p"] > tr["p"]) & (((e["name"] == "tr") & (e["table"] == tr["table"]))
                                                               | (closes("table")(e) & (e["table"] < tr["table"]))))
        return between(F.col("_in"), tr["p"] - 1, end["p"])

    rows = df.select(*held, F.posexplode(F.transform(F.filter("_in", opens("tr")), row)).alias("row_pos", "_row"))
    own = F.col("_row")[0]["table"]

    def cell(td: Column) -> Column:
        ends = lambda e: (e["p"] > td["p"]) & e["name"].isin("td", "th") & (e["table"] == own)
        inside = between(F.col("_row"), td["p"], first(F.col("_row"), ends)["p"])
        link = attribute(first(inside, lambda e: opens("a")(e) & attribute(e, "href").isNotNull()), "href")
        return F.struct(link.alias("link"), text_of(inside).alias("text"))

    cells = F.transform(F.filter("_row", lambda e: opens("td")(e) & (e["table"] == own)), cell)
    df = step(rows, [*held, "row_pos"], _td=cells).filter((F.size("_td") >= 5) & (F.col("_td")[0]["link"] != ""))
    parts = F.filter(F.transform(F.split(F.col("_td")[0]["text"], "\n"), lambda x: F.trim(x)), lambda x: x != "")
    name = F.when(F.size(parts) >= 1, parts[0]).otherwise(F.lit("Unknown"))
    vtype = F.when(F.size(parts) >= 2, parts[1]).otherwise(F.col("_dtype"))

    def value(i: int) -> Column:
        v = F.trim(F.col("_td")[i]["text"])
        return F.when(v == "", F.lit(PLACEHOLDER)).otherwise(v)

    size = split_size(F.trim(F.col("_td")[4]["text"]), PLACEHOLDER)
    return df.select(
        *keep, "row_pos", name.alias("name"), vtype.alias("type"),
        value(1).alias("year_built"), value(2).alias("gross_tonnage"), value(3).alias("deadweight"),
        size["length_m"].alias("length_m"), size["beam_m"].alias("beam_m"),
        absolute_url(F.col("_td")[0]["link"], base_url).alias("detail_link"))


def _port_texts(inside: Column, anchor: Column, second: Column, base_url: str) -> dict[str, Column]:
    """Text of the link, text of the second element and target of a departure
    or destination block."""
    linked = F.array_join(strings(between(inside, anchor["p"], first(inside, lambda e: (e["p"] > anchor["p"]) & closes("a")(e))["p"])), "")
    return {"linked": F.when(anchor.isNotNull(), linked),
            "eta": F.when(second.isNotNull(), text_of(between(inside, second["p"], end_of(inside, second["p"], "div")))),
            "link": F.coalesce(let(attribute(anchor, "href"), lambda link: absolute_url(link, base_url)), F.lit(""))}


def _port_parts(linked: Column, eta: Column) -> dict[str, Column]:
    """Port and country from the text of the link, else of the second element."""
    parts = F.split(F.coalesce(linked, eta, F.lit("")), ",")
    part = lambda i: F.trim(F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit("")))
    return {"port": part(1), "country": part(2)}


def extract_vessel_details(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None,
                           as_of_year: int, base_url: str = "") -> DataFrame:
    """Departure, destination and report fields of vessel detail pages.

    A page that cannot be read gives blanks, and says why in ``error``: no
    text at all, none of the blocks, or a block that does not end."""
    keep = keep or []
    df = page_events(pages.select(*keep, F.col(html_col).alias("_html")), keep, "_html")
    ev, blank = F.col("ev"), F.lit("")
    df = step(df, [*keep, "ev"], _dep=first(ev, opens("div", *DEPARTURE_BLOCK.split()))["p"],
              _dst=first(ev, opens("div", *DESTINATION_BLOCK.split()))["p"], _tab=first(ev, opens("table"))["p"])
    df = step(df, [*keep, "ev", "_dep", "_dst", "_tab"], _dep_end=end_of(ev, F.col("_dep"), "div"), _dst_end=end_of(ev, F.col("_dst"), "div"),
              _tab_end=end_of(ev, F.col("_tab"), "table"))
    unclosed = F.lit(False)
    for b in ("_dep", "_dst", "_tab"):
        unclosed = unclosed | (F.col(b).isNotNull() & F.col(f"{b}_end").isNull())
    error = F.when(F.size("ev") == 0, F.lit("empty page")) \
        .when(F.col("_dep").isNull() & F.col("_dst").isNull() & F.col("_tab").isNull(), F.lit("no vessel blocks")) \
        .when(unclosed, F.lit("unclosed block"))
    whole = {b: F.when(F.col(f"{b}_end").isNotNull(), between(ev, F.col(b), F.col(f"{b}_end"))).otherwise(F.array().cast(f"array<{EVENT}>"))
             for b in ("_dep", "_dst", "_tab")}
    df = step(df, keep, error=error, **whole)
    marks = {}
    for b in ("_dep", "_dst"):
        marks[f"{b}_a"] = first(F.col(b), opens("a", PORT_LINK_CLASS))
        marks[f"{b}_2"] = F.try_element_at(F.filter(b, opens("div")), F.lit(2))
    # the cell after the one that holds the label
    label = first(F.col("_tab"), lambda e: (e["kind"] == "text") & F.contains(e["t"], F.lit(STATUS_LABEL)) & F.rtrim(e["t"]).endswith(STATUS_LABEL))
    marks["_status"] = let(label["p"], lambda p: first(F.col("_tab"), lambda e: (e["p"] > p) & opens("td")(e)))
    marks["_icon"] = attribute(first(F.col("_tab"), opens("svg", *REPORT_ICON_CLASS.split())), "data-title")
    df = step(df, [*keep, "error", "_dep", "_dst", "_tab"], **marks)
    blocks = ("_dep", "_dst")
    texts = {f"{b}_{n}": c for b in blocks for n, c in _port_texts(F.col(b), F.col(f"{b}_a"), F.col(f"{b}_2"), base_url).items()}
    status_end = first(F.col("_tab"), lambda e: (e["p"] > F.col("_status")["p"]) & e["name"].isin("td", "th", "tr", "table"))["p"]
    texts["_reported"] = F.array_join(strings(between(F.col("_tab"), F.col("_status")["p"], status_end)), " ")
    df = step(df, [*keep, "error", "_icon"], **texts)
    parts = {f"{b}_{n}": c for b in blocks for n, c in _port_parts(F.col(f"{b}_linked"), F.col(f"{b}_eta")).items()}
    times = {"_dep_eta": "departure", "_dst_eta": "arrival", "_icon": "report"}
    found = {f"_{n}_{i}": m for c, n in times.items() for i, m in enumerate(eta_matches(F.col(c)))}
    df = step(df, [*keep, "error", "_reported", *[f"{b}_link" for b in blocks]], **parts, **found)
    date = lambda n: F.coalesce(eta_from_matches([F.col(f"_{n}_0"), F.col(f"_{n}_1")], as_of_year), blank)
    return df.select(
        *keep,
        date("departure").alias("departure_date"), F.col("_dep_country").alias("last_port_country"),
        F.col("_dep_port").alias("last_port_name"),
        date("arrival").alias("arrival_date"), F.col("_dst_country").alias("destination_port_country"),
        F.col("_dst_port").alias("destination_port_name"), F.col("_dst_link").alias("destination_link"),
        F.col("_reported").alias("reported_status"), date("report").alias("report_date"), "error")


def extract_port_coordinates(port_pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, lat_text, lon_text)`` from port pages ("... is located in ...
    at 23.9806S, 46.3377W"); blanks when the sentence is absent."""
    # Fixed value: the sentence that gives a port's place
    pat = r"is located in .* at (\d+\.\d+[NS]), (\d+\.\d+[EW])"
    text = html_text(_c(html_col))
    return port_pages.select(
        F.col(url_col).alias("url"),
        F.regexp_extract(text, pat, 1).alias("lat_text"),
        F.regexp_extract(text, pat, 2).alias("lon_text"))


def with_port_coordinates(details: DataFrame, port_pages: DataFrame, link_col: str = "destination_link") -> DataFrame:
    """Attach destination coordinates: each distinct port page is parsed once
    and joined back by link (the join replaces a per-process cache). Rows
    without a link match nothing; each gets a key of its own, so they are not
    one hot key."""
    coords = dedupe(extract_port_coordinates(port_pages), ["url"])
    alone = F.concat(F.lit("\0"), F.xxhash64(*details.columns).cast("string"))
    keyed = step(details, details.columns, _link=F.when(F.col(link_col) != "", F.col(link_col)).otherwise(alone))
    out = keyed.join(coords, F.col("_link") == coords["url"], "left")
    return out.withColumn("destination_port_lat", F.coalesce(F.col("lat_text"), F.lit(""))) \
        .withColumn("destination_port_lon", F.coalesce(F.col("lon_text"), F.lit(""))) \
        .drop("lat_text", "lon_text", "url", "_link")
