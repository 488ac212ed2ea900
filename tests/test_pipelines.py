import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quayside.operators.cdc import live_rows
from quayside.operators.keys import KeyRegistry
from quayside.operators.quality import DataQualityError, with_metrics
from quayside.plans.dims import dim_country, dim_vessel
from quayside.plans.gold import port_dimension
from quayside.plans.quakes import (ARCHIVE_COLUMNS, apply_quake_changes, fact_earthquake, stage_quake_changes,
                                   to_archive_layout)
from quayside.plans.silver import build_silver, clean_snapshot
from quayside.session import scratch_path
from quayside.sinks.tables import publish, read_published, register_table, replace_by_key, write_csv
from quayside.sources.files import land_dated_files, month_snapshot, read_query, read_snapshot_csv
from quayside.sources.messages import decode_change_json
from quayside.spec import SchemaSpec, spark_datetime_pattern


def _msg(unid, op, ts_ms, seq, mag=5.0):
    return json.dumps({"unid": unid, "time": ts_ms, "lastupdate": ts_ms + 1000, "received_at": ts_ms + 2000,
                       "lat": 1.0, "lon": 2.0, "depth": 3.0, "mag": mag, "__op": op, "__ts_ms": seq})


def test_quake_state_and_fact(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t0 = 1704067200000  # 2024-01-01T00:00:00Z
    msgs = [_msg("a", "c", t0, 1), _msg("a", "u", t0 + 3_661_000, 3, mag=6.0), _msg("b", "r", t0, 2),
            _msg("b", "d", t0, 4), _msg("c", "c", t0, 5), '{"broken']
    raw = spark.createDataFrame([(m,) for m in msgs], "value string")
    decoded = decode_change_json(raw)
    assert decoded.filter("_malformed").count() == 1
    state = live_rows(apply_quake_changes(None, stage_quake_changes(decoded.filter(~F.col("_malformed")))))
    rows = {r.unid: r for r in state.collect()}
    assert set(rows) == {"a", "c"} and rows["a"].mag == 6.0
    assert rows["a"].time == dt.datetime(2024, 1, 1, 1, 1, 1) and rows["a"].event_date == dt.date(2024, 1, 1)
    fact = {r.UNID: r for r in fact_earthquake(state).collect()}
    assert (fact["a"].EARTHQUAKE_SK, fact["c"].EARTHQUAKE_SK) == (1, 2)
    assert (fact["a"].TIME_DATE_KEY, fact["a"].TIME_TIME_KEY, fact["a"].LAST_UPDATE_TIME_KEY) == (20240101, 10101, 10102)
    assert to_archive_layout(state).columns == ARCHIVE_COLUMNS


def test_replace_by_key_and_publish(spark):
    base = scratch_path(spark, "fact")
    v1 = spark.createDataFrame([("1", 10), ("1", 11), ("2", 20)], "EARTHQUAKE_KEY string, PORT_KEY long")
    publish(v1, base)
    v2 = spark.createDataFrame([("1", 12)], "EARTHQUAKE_KEY string, PORT_KEY long")
    publish(replace_by_key(read_published(spark, base), v2, ["EARTHQUAKE_KEY"]), base)
    assert sorted(tuple(r) for r in read_published(spark, base).collect()) == [("1", 12), ("2", 20)]


SPEC = SchemaSpec.from_dict({
    "validation": {"required_columns": ["oid", "name", "depth", "seen"], "allow_extra_columns": False,
                   "allow_empty_file": False},
    "columns": {"oid": {"type": "integer", "nullable": False}, "name": {"type": "string"},
                "depth": {"type": "double"}, "seen": {"type": "timestamp", "format": "%Y-%m-%d %H:%M"}},
    "partition_columns": {"snapshot_year": "integer", "snapshot_month": "integer"},
    "business_key": ["oid"],
})


def _raw(spark, rows, header="OID_,Name,Depth,Seen"):
    base = scratch_path(spark, "raw")
    for (y, m), lines in rows.items():
        spark.createDataFrame([(line,) for line in [header] + lines], "v string").coalesce(1) \
            .write.text(f"{base}/year={y}/month={m}")
    return read_snapshot_csv(spark, base)


def test_silver_build_dedupes_per_snapshot_and_observes(spark):
    raw = _raw(spark, {(2024, 1): ["1, a ,5,2024-01-02 10:00", "1, a ,5,2024-01-02 10:00", "2,,abc,bad"],
                       (2024, 2): ["1,b,6,"]})
    out = scratch_path(spark, "silver")
    stats = build_silver(raw, SPEC, out)
    got = sorted((r.oid, r.name, r.depth, r.snapshot_month) for r in spark.read.parquet(out).collect())
    # the same oid survives in both months (dedupe is per snapshot)
    assert got == [(1, "a", 5.0, 1), (1, "b", 6.0, 2), (2, None, None, 1)]
    assert stats == {"rows_out": 3}
    seen = {r.snapshot_month: r.seen for r in spark.read.parquet(out).filter("oid = 1").collect()}
    assert seen[1] == dt.datetime(2024, 1, 2, 10, 0) and seen[2] is None


def test_silver_flags_are_honoured(spark):
    with pytest.raises(DataQualityError):   # extra column with allow_extra_columns false
        clean_snapshot(_raw(spark, {(2024, 1): ["1,a,5,x,9"]}, "OID_,Name,Depth,Seen,Extra"), SPEC)
    with pytest.raises(DataQualityError):   # missing required column
        clean_snapshot(_raw(spark, {(2024, 1): ["1,a"]}, "OID_,Name"), SPEC)
    with pytest.raises(DataQualityError):   # NULL in a non-nullable column
        clean_snapshot(_raw(spark, {(2024, 1): [",a,5,"]}), SPEC).collect()
    kept = clean_snapshot(_raw(spark, {(2024, 1): [",a,5,", "3,c,1,"]}), SPEC, on_null="drop")
    assert [r.oid for r in kept.collect()] == [3]
    assert spark_datetime_pattern("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"


def test_gold_dimension_with_registry(spark):
    silver = spark.createDataFrame(
        [(101, "yes", 2024, 1), (205, "no", 2024, 2), (101, "yes", 2024, 2), (101, "yes", 2024, 2)],
        "oid int, repairs string, snapshot_year int, snapshot_month int")
    for c in ["supplies_provisions", "supplies_fuel_oil", "supplies_diesel_oil", "supplies_potable_water",
              "communications_radio", "communications_telephone", "communications_airport", "communications_telefax"]:
        silver = silver.withColumn(c, F.lit("yes"))
    reg = KeyRegistry(spark, scratch_path(spark, "reg"), "oid", "port_key")
    cols = ["port_key", "oid", "supplies_count", "supplies_rate", "communications_count", "comm_rate"]
    got = {r.oid: tuple(r) for r in port_dimension(silver, cols, registry=reg).collect()}
    assert got == {101: (1, 101, 5, "Excellent", 4, "Excellent"), 205: (2, 205, 4, "Good", 4, "Excellent")}


def test_land_dated_files_skips_bad_names(spark):
    src = scratch_path(spark, "drop")
    for name, rows in [("ports_2024-03-05.csv", ["a,1", "b,2"]), ("ports_latest.csv", ["c,3"]),
                       ("ports_2024-04-01.csv", ["d,4"])]:
        spark.createDataFrame([(x,) for x in ["k,v"] + rows], "v string").coalesce(1).write.text(f"{src}/{name}")
    landed = land_dated_files(spark, src, scratch_path(spark, "landed"), "ports")
    got = sorted((r.k, int(r.year), int(r.month)) for r in landed.collect())
    assert got == [("a", 2024, 3), ("b", 2024, 3), ("d", 2024, 4)]
    assert {str(r.file_date) for r in landed.collect()} == {"2024-03-05", "2024-04-01"}


def test_sources_and_sinks_helpers(spark):
    spark.createDataFrame([(1, "x")], "a int, b string").createOrReplaceTempView("t_src")
    assert read_query(spark, "SELECT a FROM t_src").first().a == 1
    out = scratch_path(spark, "csv")
    assert not write_csv(spark.createDataFrame([], "a int"), out)
    assert write_csv(spark.createDataFrame([(1,)], "a int"), out)
    snap = month_snapshot(spark.createDataFrame([(1,)], "a int"), dt.date(2026, 8, 17)).first()
    assert snap.snapshot_date == dt.date(2026, 8, 1)
    with pytest.raises(DataQualityError):
        month_snapshot(spark.createDataFrame([], "a int"), dt.date(2026, 8, 17))
    part = scratch_path(spark, "tbl")
    spark.createDataFrame([(1, 2024)], "a int, y int").write.partitionBy("y").parquet(part)
    register_table(spark, "t_registered", part, "a int, y int", ["y"])
    assert spark.table("t_registered").count() == 1


def test_dim_country_and_vessel(spark):
    c = spark.createDataFrame([("BR", "Brazil"), ("NL", "Netherlands"), ("BR", "Brazil")], "code string, name string")
    got = sorted(tuple(r) for r in dim_country(c, "code", "name").collect())
    assert got == [(1, "BR", "Brazil"), (2, "NL", "Netherlands")]
    v = spark.createDataFrame([("x", "/v/1", 1), ("x2", "/v/1", 2), ("y", "/v/2", 1)],
                              "name string, detail_link string, seen int")
    out = {r.detail_link: (r.VESSEL_KEY, r.name) for r in dim_vessel(v, order=["seen"]).collect()}
    assert out == {"/v/1": (1, "x2"), "/v/2": (2, "y")}
    _, obs = with_metrics(v, "m")
    assert obs is not None


def test_registry_only_missing_path_means_first_load(spark):
    path = scratch_path(spark, "badreg")
    spark.createDataFrame([("not parquet",)], "v string").write.text(path)
    reg = KeyRegistry(spark, path, "oid", "port_key")
    with pytest.raises(Exception):
        reg.assign(spark.createDataFrame([(1,)], "oid int")).collect()
    assert KeyRegistry(spark, scratch_path(spark, "nothing-here"), "oid", "port_key").read() is None


def test_archive_keeps_late_arrivals(spark):
    from quayside.plans.archive import incremental_archive

    rows = [(1, dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6)),
            (2, dt.datetime(2024, 1, 1, 7), dt.datetime(2024, 1, 3, 9))]   # event on Jan 1, arrives Jan 3
    src = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, received_at timestamp_ntz")
    archive, control = scratch_path(spark, "late-arch"), scratch_path(spark, "late-ctl")
    for run_end in (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 4)):
        incremental_archive(spark, src, archive_path=archive, control_base=control, pipeline="p",
                            slice_col="received_at", event_ts="ts", keys=["event_id"], run_end=run_end,
                            as_of=dt.datetime(2024, 2, 1))
    got = sorted((r.event_id, r.day) for r in spark.read.parquet(archive).collect())
    assert got == [(1, 1), (2, 1)]   # the late row is archived, under its event date


def test_latest_snapshot_prunes_partitions(spark):
    from quayside.operators.snapshot import latest_snapshot

    path = scratch_path(spark, "snaps")
    spark.createDataFrame([(1, 2023, 12), (2, 2024, 1), (3, 2024, 2)], "oid int, snapshot_year int, snapshot_month int") \
        .write.partitionBy("snapshot_year", "snapshot_month").parquet(path)
    df = latest_snapshot(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(snapshot_month#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert [r.oid for r in df.collect()] == [3]


def test_empty_landed_file_is_rejected(spark):
    raw = _raw(spark, {(2024, 1): []})   # header only
    with pytest.raises(DataQualityError):
        clean_snapshot(raw, SPEC)
