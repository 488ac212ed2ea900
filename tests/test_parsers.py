import datetime as dt
import json

from pyspark.sql import types as T

from quayside.functions.parse import parse_coordinate, parse_eta, parse_event_time, split_port, split_size
from quayside.sources.html import extract_listing_rows, extract_total_pages, extract_vessel_details
from quayside.sources.messages import decode_json, flatten_seismic_messages, unwrap_cdc_envelope


def _one(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr_fn("v")).collect()]


def test_parse_eta_examples(spark):
    got = _one(spark, ["Aug 29, 00:00", "ETA: Sep 3, 2026 12:30", "Foo 3, 2026 12:30", "", None,
                       "Arrived Jan 5, 1996, 00:00", "January 5 10:00"], lambda c: parse_eta(c, 2030))
    assert got == ["2030-08-29 00:00", "2026-09-03 12:30", "", "", "", "1996-01-05 00:00", ""]


def test_parse_coordinate(spark):
    got = _one(spark, ["23.9806S", "103.7566E", "46.3377W", "12.5N", "95.0N", "bad", None], parse_coordinate)
    assert got == [-23.9806, 103.7566, -46.3377, 12.5, None, None, None]


def test_parse_event_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = _one(spark, ["1704067207179", "2024-01-01T00:00:07.179575Z", "garbage", None], parse_event_time)
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert got[1] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert got[2] is None and got[3] is None


def test_split_size_and_port(spark):
    df = spark.createDataFrame([("200 / 32",), ("150",), ("",), (None,)], "s string")
    assert [(r.length_m, r.beam_m) for r in df.select(*[c.alias(n) for n, c in split_size("s").items()]).collect()] \
        == [("200", "32"), ("150", "-"), ("-", "-"), ("-", "-")]
    df = spark.createDataFrame([("Santos, Brazil",), ("Rotterdam",)], "s string")
    assert [tuple(r) for r in df.select(*split_port("s").values()).collect()] == [("Santos", "Brazil"), ("Rotterdam", "")]


def test_seismic_flatten_edge_cases(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    msgs = [
        {"action": "create", "data": {"geometry": {"coordinates": [10.5, 20.5, -7.0]},
                                      "properties": {"unid": "a", "time": 1704067200000, "mag": 5.1}}},
        {"action": "update", "data": {"geometry": {"coordinates": [1.0, 2.0]},
                                      "properties": {"unid": "b", "time": "2024-01-01T00:00:00Z"}}},
        {"data": {"properties": {"unid": "c", "time": "garbage"}}},
        {"action": "delete", "data": {"geometry": {"coordinates": [1, 2, 3]}}},
        {"action": "x", "data": {"properties": {}}},
    ]
    df = spark.createDataFrame([(json.dumps(m),) for m in msgs] + [("{not json",), (None,)], "value string")
    rows = {r.unid: r for r in flatten_seismic_messages(df).collect()}
    assert set(rows) == {"a", "b", "c"}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert (a.lat, a.lon, a.depth, a.mag, a.source_id) == (20.5, 10.5, 7.0, 5.1, "N/A")
    assert a.time == dt.datetime(2024, 1, 1) and b.time == dt.datetime(2024, 1, 1) and c.time is None
    assert (b.depth, b.mag, c.lat, c.action) == (0.0, 0.0, 0.0, "unknown")


def test_decode_json_flags_malformed(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("op", T.StringType())])
    df = spark.createDataFrame([('{"k": 1, "op": "c"}',), ('{"k": 2, "op"',), (None,)], "value string")
    got = [(r.k, r.op, r._malformed) for r in decode_json(df, schema).collect()]
    assert got == [(1, "c", False), (None, None, True), (None, None, True)]


def test_envelope_unwrap_keeps_deletes(spark):
    row = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    msgs = [{"before": None, "after": {"k": 1, "v": "a"}, "op": "c", "ts_ms": 1},
            {"before": {"k": 1, "v": "a"}, "after": {"k": 1, "v": None}, "op": "u", "ts_ms": 2},
            {"before": {"k": 1, "v": None}, "after": None, "op": "d", "ts_ms": 3}]
    df = spark.createDataFrame([(json.dumps(m),) for m in msgs], "value string")
    got = [(r.k, r.v, r["__op"], r["__ts_ms"]) for r in unwrap_cdc_envelope(df, row).collect()]
    assert got == [(1, "a", "c", 1), (1, None, "u", 2), (1, None, "d", 3)]


LISTING = """<html><p>Page 1 of 7</p><table>
<tr><th>Vessel</th></tr>
<tr><td><a href="/v/1">ALPHA
Bulk Carrier</a></td><td>2001</td><td>5000</td><td>8000</td><td>200 / 32</td></tr>
<tr><td><a href="https://x.org/v/2">BETA</a></td><td></td><td>1</td><td>2</td><td>150</td></tr>
<tr><td>no link</td><td>1</td><td>2</td><td>3</td><td>4</td></tr>
<tr><td><a href="/v/3">SHORT</a></td><td>1</td></tr>
</table><table><tr><td><a href="/v/9">IGNORED</a></td><td>1</td><td>2</td><td>3</td><td>4</td></tr></table></html>"""


def test_listing_rows_and_pages(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, "<html>nothing</html>")], "page_id long, html string")
    rows = extract_listing_rows(pages, keep=["page_id"], default_type="Cargo", base_url="https://site").collect()
    got = [(r.name, r.type, r.year_built, r.length_m, r.beam_m, r.detail_link) for r in rows]
    assert got == [("ALPHA", "Bulk Carrier", "2001", "200", "32", "https://site/v/1"),
                   ("BETA", "Cargo", "-", "150", "-", "https://x.org/v/2")]
    assert [r[0] for r in pages.select(extract_total_pages("html")).collect()] == [7, 1]


def test_vessel_details_blank_when_missing(spark):
    html = ('<div class="vi__r1 vi__stp"><a class="_npNa" href="/ports/A">Santos, Brazil</a><div>x</div>'
            '<div>ATD: Aug 29, 2026 10:00</div></div><div class="vi__r1 vi__sbt"><div>x</div>'
            '<div>Rotterdam, Netherlands</div></div>'
            '<table><tr><td>Navigation Status</td><td>Moored</td></tr></table>')
    pages = spark.createDataFrame([(1, html), (2, "<html></html>")], "page_id long, html string")
    r = {x.page_id: x for x in extract_vessel_details(pages, keep=["page_id"], as_of_year=2026).collect()}
    assert (r[1].departure_date, r[1].last_port_name, r[1].last_port_country) == ("2026-08-29 10:00", "Santos", "Brazil")
    assert (r[1].destination_port_name, r[1].destination_port_country, r[1].arrival_date) == \
        ("Rotterdam", "Netherlands", "")
    assert (r[1].reported_status, r[1].report_date) == ("Moored", "")
    assert all(getattr(r[2], f) == "" for f in ["departure_date", "last_port_name", "destination_port_name",
                                                "reported_status", "report_date"])
