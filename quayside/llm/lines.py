"""Line dedup by distinct-site spread, in DataFrame functions only.

A line (its text without blanks at the ends) that occurs on many sites is
boilerplate. Per line hash a HyperLogLog sketch of the sites is kept; the
partial sketches of all tasks merge by aggregation. A sketch decides alone
where its estimate is away from the threshold by more than ``BAND``, five
times its relative standard error; the lines in between get an exact count of
their distinct sites. Of a boilerplate line one occurrence is kept, the first
by doc_id and line number, so no content is lost from the corpus; all its
other occurrences are removed.

Lines are known by two independent 64-bit hashes. Texts move once, to be
joined with the numbers of the lines that they lose.

Defined cases: a null text has no lines and stays null; blank lines are never
counted and never removed; an empty text stays empty; a null site is no site;
a null doc_id sorts first; rows with equal id and text are alike (each keeps a
line of which they hold the first occurrence); an empty table gives an empty
result; other columns pass through ``drop_boilerplate`` untouched, but for
those of names that it adds or uses inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import staged

MIN_SITES = 10
LOG_K = 10  # 2^10 registers: relative standard error 1.04 / 2^5
BAND = 5 * 1.04 / 2 ** (LOG_K / 2)


def split_lines(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """A document row is known by its id and text."""
    return [F.col(id_col).alias("_doc"), F.xxhash64(F.lit(3), text_col).alias("_text_hash")]


def line_table(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per line that is not blank: its document, number, site and hashes."""
    rows = docs.filter(F.col(text_col).isNotNull()).select(
        *row_key(id_col, text_col), F.col(site_col).alias("_site"),
        F.posexplode(F.transform(split_lines(text_col), lambda x: F.trim(x))).alias("_n", "_line"))
    return rows.filter("_line <> ''").select(
        "_doc", "_text_hash", "_n", "_site", F.xxhash64(F.lit(1), "_line").alias("_h1"), F.xxhash64(F.lit(2), "_line").alias("_h2"))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """(_h1, _h2, _first): the lines on at least ``min_sites`` sites and where each occurs first."""
    spread = staged(lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_agg(F.xxhash64("_site"), F.lit(LOG_K)).alias("_sketch"),
        F.min(F.struct("_doc", "_n", "_text_hash")).alias("_first"))
        .select("_h1", "_h2", "_first", F.hll_sketch_estimate("_sketch").alias("_sites"))
        # lines far below the threshold are decided here
        .filter(F.col("_sites") >= min_sites * (1 - BAND)), "line-spread")
    sure = spread.filter(F.col("_sites") > min_sites * (1 + BAND)).select("_h1", "_h2", "_first")
    near = spread.filter(F.col("_sites") <= min_sites * (1 + BAND)).select("_h1", "_h2", "_first")
    # one row per line and site before the join, so a hot line moves few rows
    sites = lines.filter(F.col("_site").isNotNull()).select("_h1", "_h2", "_site").distinct()
    exact = sites.join(near, ["_h1", "_h2"]).groupBy("_h1", "_h2").agg(
        F.count("*").alias("_exact"), F.min("_first").alias("_first")).filter(F.col("_exact") >= min_sites)
    return staged(sure.unionByName(exact.select("_h1", "_h2", "_first")), "line-boilerplate")


def lost_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """(_doc, _text_hash, _lost): per document the numbers of the lines it loses."""
    lines = line_table(docs, id_col, text_col, site_col)
    found = boilerplate(lines, min_sites)
    here = F.struct("_doc", "_text_hash")
    first = F.struct("_first._doc", "_first._text_hash")
    gone = lines.join(found, ["_h1", "_h2"]).filter(
        ~(here.eqNullSafe(first) & (F.col("_n") == F.col("_first._n"))))
    return gone.groupBy("_doc", "_text_hash").agg(F.collect_set("_n").alias("_lost"))


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text",
                     site_col: str = "source") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of the text, and the
    columns n_lines and n_removed (which replace columns of those names)."""
    docs = docs.drop("n_lines", "n_removed", "_doc", "_text_hash", "_lost", "_lost_doc", "_lost_text")
    doc, text_hash = row_key(id_col, text_col)
    lost = lost_lines(docs, id_col, text_col, site_col, min_sites) \
        .select(F.col("_doc").alias("_lost_doc"), F.col("_text_hash").alias("_lost_text"), "_lost")
    joined = docs.withColumns({"_doc": doc, "_text_hash": text_hash}).join(
        lost, F.col("_doc").eqNullSafe(F.col("_lost_doc")) & (F.col("_text_hash") == F.col("_lost_text")), "left")
    lines = split_lines(text_col)
    count = F.coalesce(F.size(lines), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), count - 1), F.col("_lost"))
    text = F.when(F.col("_lost").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n"))
    return joined.withColumns({
        "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(count),
        "n_removed": F.coalesce(F.size("_lost"), F.lit(0)), text_col: text,
    }).drop("_doc", "_text_hash", "_lost_doc", "_lost_text", "_lost")


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, n, trim(line, ' ') AS line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
    FROM documents WHERE text IS NOT NULL)
  WHERE trim(line, ' ') <> ''),
wide AS (
  SELECT line, min(struct_pack(doc_id := doc_id, n := n)) AS first FROM lines
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
lost AS (
  SELECT l.doc_id, l.n FROM lines l JOIN wide w ON l.line = w.line
  WHERE NOT (l.doc_id = w.first.doc_id AND l.n = w.first.n)),
per_doc AS (SELECT doc_id, list(n) AS ns FROM lost GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS n_lines,
       CAST(coalesce(len(p.ns), 0) AS INTEGER) AS n_removed,
       sha256(CASE WHEN p.ns IS NULL THEN d.text ELSE array_to_string(
         list_filter(string_split(d.text, chr(10)), lambda x, i: NOT list_contains(p.ns, i - 1)), chr(10)) END) AS kept_sha256
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id
"""
