"""Tag events: odd markup, blocks that do not end, and plans that read a page once."""

import re

import pytest
from pyspark.sql import functions as F

from quayside.sources.html import extract_listing_rows, extract_vessel_details, with_port_coordinates
from quayside.sources.markup import attribute, between, end_of, first, opens, page_events, strings

DETAIL = """<div class="vi__r1 vi__sbt"><a class="_npNa" href="/ports/A">Santos, Brazil</a><div>x</div><div>ETA: Aug 29 10:00</div></div>
<table><tr><td>Navigation Status</td><td>Moored</td></tr></table>"""


def events(spark, *pages):
    df = page_events(spark.createDataFrame(list(enumerate(pages)), "i int, html string"), ["i"])
    return [[(e["kind"], e["name"], e["t"]) for e in r.ev] for r in df.orderBy("i").collect()]


def test_tokens(spark):
    got = events(spark, "a<b>c</b><DIV x='>' y=\"<td>\">d</div >", "<!-- <td> --><script>if (a<b) '<td>'</script><td>1 < 2<style>td</style>",
                 None, "", "<div class='never ends", "text only & more", "<a/><svg /><td/>")
    assert [[x[:2] for x in page] for page in got] == [
        [("text", ""), ("text", ""), ("open", "div"), ("text", ""), ("close", "div")],
        [("open", "td"), ("text", ""), ("text", ""), ("text", "")], [], [], [("open", "div")], [("text", "")],
        [("open", "a"), ("both", "svg"), ("both", "td")]]


@pytest.mark.parametrize("tag,want", [
    ('<a class="x" href="/p">', "/p"), ("<a href='/p' class=x>", "/p"), ("<a href=/p>", "/p"), ("<A HREF = \"/p\">", "/p"),
    ("<a title='href=\"/no\"' href=/p>", "/p"), ("<a data-href='/no'>", None), ("<a href>", None), ("<a href='/a&amp;b'>", "/a&b"),
    ("<a disabled href='/p'>", "/p"), ("<a title=\"a 'b' href=/no\" href='/p'>", "/p")])
def test_attribute(spark, tag, want):
    df = page_events(spark.createDataFrame([(tag,)], "html string"), [])
    assert df.select(attribute(first(F.col("ev"), opens("a")), "href")).first()[0] == want


def test_nested_elements_end_where_they_should(spark):
    df = page_events(spark.createDataFrame([("<div class=a><div>1</div><div>2<div>3</div></div></div></div><div>4</div>",)], "html string"), [])
    start = first(F.col("ev"), opens("div", "a"))["p"]
    end, inside = df.select(end_of(F.col("ev"), start, "div"), strings(F.filter("ev", lambda e: e["p"] < end_of(F.col("ev"), start, "div")))).first()
    assert (end, inside) == (10, ["1", "2", "3"])


def test_errors(spark):
    pages = [(1, DETAIL), (2, None), (3, " "), (4, "<p>hello</p>"), (5, DETAIL.replace("</table>", "")), (6, "<div class='vi__r1 vi__stp'><div>")]
    got = {r.page_id: r for r in extract_vessel_details(spark.createDataFrame(pages, "page_id int, html string"), keep=["page_id"], as_of_year=2024).collect()}
    assert [got[i].error for i in range(1, 7)] == [None, "empty page", "no vessel blocks", "no vessel blocks", "unclosed block", "unclosed block"]
    assert (got[1].destination_port_name, got[1].arrival_date, got[1].reported_status) == ("Santos", "2024-08-29 10:00", "Moored")
    assert got[5].reported_status == "" and got[5].destination_port_name == "Santos"  # what does end is read


def test_nested_table_rows(spark):
    html = """<table><tr><td><a href=/v/1>ONE</a><table><tr><td>n</td></tr></table></td><td>2001</td><td>1</td><td>2</td><td>9 / 3</td></tr>
    <tr><td><a href=/v/2>TWO<td>2002<td>1<td>2<td>8</table><table><tr><td><a href=/v/9>X</a><td>1<td>1<td>1<td>1</table>"""
    rows = extract_listing_rows(spark.createDataFrame([(html,)], "html string"), default_type="T").collect()
    assert [(r.detail_link, r.year_built, r.length_m, r.beam_m) for r in rows] == [("/v/1", "2001", "9", "3"), ("/v/2", "2002", "8", "-")]


def test_a_page_is_read_once(spark):
    """One scan, no regular expression in a filter or join, each step's Generate
    kept, and generated code that compiles."""
    from quayside.workloads.w_html import detail_pages, port_pages, ports

    sf = "/root/testdata/sf0.001"
    pages = detail_pages(spark, sf, ports(spark, sf).count())
    path = f"{spark.sparkContext.getCheckpointDir()}/markup-pages"
    pages.write.mode("overwrite").parquet(path)
    out = with_port_coordinates(extract_vessel_details(spark.read.parquet(path), keep=["page_id"], as_of_year=2026), port_pages(spark, sf))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [page_id") == 1
    for line in plan.splitlines():
        if re.match(r"[\s:+-]*(Filter|Join)", line):
            assert "regexp" not in line and len(line) < 2000, line[:200]
    assert len(plan) < 80_000


def test_texts_of_a_block_are_read_once(spark):
    """The plan joins the texts of a link, of a second element (two blocks)
    and of the status once each, whatever is made of them."""
    pages = spark.createDataFrame([(1, "<p>")], "page_id int, html string")
    plan = extract_vessel_details(pages, keep=["page_id"], as_of_year=2026)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join(") == 5 and "array_position(" not in plan


def test_parts_are_cut_by_place(spark):
    """Any part of an array, and of a part of one, by its places."""
    ev = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct(i.alias("p")))
    bounds = [None, -1, 0, 2, 4, 5, 9]
    rows = spark.createDataFrame([(a, b, c, d) for a in bounds for b in bounds for c in (None, -1, 1, 3) for d in (None, 1, 4, 9)], "a int, b int, c int, d int")
    cut = between(between(ev, F.col("a"), F.col("b")), F.col("c"), F.col("d"))
    last = 1 << 30
    for r in rows.select("*", cut["p"].alias("got")).collect():
        inside = [p for p in range(6) if r.a is not None and r.a < p < (last if r.b is None else r.b)]
        assert r.got == [p for p in inside if r.c is not None and r.c < p < (last if r.d is None else r.d)], r
