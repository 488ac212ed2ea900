import pytest
from pyspark.sql import functions as F

from quayside.functions.flags import add_communication_metrics, add_supply_metrics, availability_flag
from quayside.functions.names import standardize_column_name, standardize_name
from quayside.operators.clean import (blank_to_null, cast_rejects, cast_to_spec, conform, exclude_containing,
                                      null_tokens, standardize_columns, trim_strings)
from quayside.operators.dedupe import dedupe
from quayside.operators.quality import (DataQualityError, check_columns, expect_not_null, null_report,
                                        raise_on_nulls, reconcile)
from quayside.operators.snapshot import apply_retention, incremental_slice, latest_snapshot

NAMES = {"OID_": "oid", "IHO S-57 Electronic Navigational Chart": "iho_s57_electronic_navigational_chart",
         "Lifts - 100+ Tons": "lifts_100_plus_tons", "Lifts - 50-100 Tons": "lifts_50_100_tons",
         "Tidal Range (m)": "tidal_range_m", "length(m)": "length_m"}


def test_standard_names_python_and_column(spark):
    for raw, want in NAMES.items():
        assert standardize_column_name(raw) == want
    df = spark.createDataFrame([(k,) for k in NAMES], "n string")
    got = [r[0] for r in df.select(standardize_name("n")).collect()]
    assert got == list(NAMES.values())


def test_standardize_columns_detects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`Tidal Range (m)` int, `tidal range m` int")
    with pytest.raises(ValueError, match="both standardise"):
        standardize_columns(df)
    ok = standardize_columns(spark.createDataFrame([(1,)], "`OID_` int"))
    assert ok.columns == ["oid"]


def test_blank_trim_cast_and_rejects(spark):
    df = spark.createDataFrame([("  ", " 12 ", "x"), ("", "abc", " y "), (None, "7", "z")], "a string, n string, s string")
    clean = cast_to_spec(trim_strings(blank_to_null(df)), {"n": "int"})
    assert [tuple(r) for r in clean.collect()] == [(None, 12, "x"), (None, None, "y"), (None, 7, "z")]
    rej = cast_rejects(trim_strings(blank_to_null(df)), {"n": "int"}).collect()
    assert [r.n for r in rej] == ["abc"]
    with pytest.raises(Exception):
        cast_to_spec(df, {"n": "int"}, on_error="fail").collect()


def test_timestamp_cast_with_format(spark):
    df = spark.createDataFrame([("2026-08-17 10:30",), ("bad",)], "t string")
    out = cast_to_spec(df, {"t": "timestamp_ntz"}, {"t": "yyyy-MM-dd HH:mm"}).collect()
    assert str(out[0].t) == "2026-08-17 10:30:00" and out[1].t is None


def test_conform_fail_and_fill(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        conform(df, ["k", "missing"])
    out = conform(df, ["v", "extra", "k"], missing="fill", fill="")
    assert out.columns == ["v", "extra", "k"] and out.first().extra == ""


def test_null_tokens_and_exclude(spark):
    df = spark.createDataFrame([("-",), ("Destination not available",), ("Bulk",), ("Water TANKER x",), (None,)],
                               "t string")
    assert [r.t for r in null_tokens(df, ["t"], ["-", "", "Destination not available"]).collect()] == \
        [None, None, "Bulk", "Water TANKER x", None]
    assert [r.t for r in exclude_containing(df, "t", "water tanker").collect()] == \
        ["-", "Destination not available", "Bulk", None]


def test_availability_tokens_and_bands(spark):
    vals = ["Yes", " y ", "TRUE", "1", "Available", "No", "n", "0", "Unknown", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(availability_flag("v")).collect()] == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0]
    cols = ["supplies_provisions", "supplies_fuel_oil", "supplies_diesel_oil", "supplies_potable_water", "repairs",
            "communications_radio", "communications_telephone", "communications_airport", "communications_telefax"]
    rows = [tuple(["yes"] * n + ["no"] * (5 - n) + ["yes"] * min(n, 4) + ["no"] * (4 - min(n, 4))) for n in range(6)]
    out = add_communication_metrics(add_supply_metrics(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))))
    got = [(r.supplies_count, r.supplies_rate, r.communications_count, r.comm_rate) for r in out.collect()]
    assert got == [(0, "Unavailable", 0, "Unavailable"), (1, "Limited", 1, "Limited"), (2, "Limited", 2, "Limited"),
                   (3, "Good", 3, "Good"), (4, "Good", 4, "Excellent"), (5, "Excellent", 4, "Excellent")]


def test_check_columns_flags(spark):
    df = spark.createDataFrame([(1, 2)], "a int, extra int")
    assert check_columns(df, ["a"]) == {"missing": [], "extra": ["extra"]}
    with pytest.raises(DataQualityError):
        check_columns(df, ["a"], allow_extra=False)
    with pytest.raises(DataQualityError):
        check_columns(df, ["a", "b"])
    assert check_columns(df, ["a", "b"], allow_missing=True)["missing"] == ["b"]


def test_null_report_and_expect_not_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None), (3, 3.0, "z")], "k int, d double, s string")
    rep = {r.column_name: r.null_count for r in null_report(df, ["k", "d", "s"]).collect()}
    assert rep == {"k": 1, "d": 2, "s": 1}
    bad = {r.k: r.failed_columns for r in expect_not_null(df, ["k", "d"]).collect()}
    assert bad == {1: "d", None: "k,d"}
    with pytest.raises(DataQualityError):
        raise_on_nulls(df, ["k"])


def test_dedupe_is_deterministic_and_handles_hot_key(spark):
    rows = [(1, i % 5, f"v{i}") for i in range(300)] + [(2, 0, "only")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    a = {r.k: (r.t, r.v) for r in dedupe(df, ["k"], ["t"]).collect()}
    b = {r.k: (r.t, r.v) for r in dedupe(df.repartition(7), ["k"], ["t"]).collect()}
    assert a == b == {1: (4, "v99"), 2: (0, "only")}
    first = {r.k: r.v for r in dedupe(df, ["k"], ["t"], keep="first").collect()}
    assert first[1] == "v0"


def test_latest_snapshot_slice_retention(spark):
    df = spark.createDataFrame([(1, 2023, 12), (2, 2024, 1), (3, 2024, 1), (4, 2023, 11)],
                               "oid int, snapshot_year int, snapshot_month int")
    assert sorted(r.oid for r in latest_snapshot(df).collect()) == [2, 3]
    with pytest.raises(DataQualityError):
        latest_snapshot(df.limit(0))
    import datetime as dt
    ts = spark.createDataFrame([(1, dt.datetime(2024, 1, 10)), (2, dt.datetime(2024, 1, 20)),
                                (3, dt.datetime(2024, 1, 15)), (4, None)], "id int, ts timestamp_ntz")
    sl = incremental_slice(ts, "ts", after=dt.datetime(2024, 1, 10), up_to=dt.datetime(2024, 1, 20))
    assert sorted(r.id for r in sl.collect()) == [2, 3]  # lower bound out, upper bound in
    kept = apply_retention(ts, "ts", "2 days", dt.datetime(2024, 1, 20))
    assert sorted(r.id for r in kept.collect()) == [2, 4]  # NULL time stamps are kept


def test_reconcile(spark):
    exp = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    act = spark.createDataFrame([(1,), (3,)], "k int")
    r = reconcile(exp, act, ["k"]).first()
    assert (r.expected_rows, r.actual_rows, r.missing_rows, r.status) == (3, 2, 1, "FAIL")
    assert reconcile(exp, exp, ["k"]).first().status == "OK"
    assert F is not None
