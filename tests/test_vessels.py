"""Runs across ranges, trips, and the interval join of vessel port risk."""

import datetime as dt
import random

import pytest

import __spark_entry__ as entry
from quayside.operators.runs import number_runs, ranged
from quayside.plans.facts import fact_earthquake_port_risk, fact_vessel_port_risk, fact_vessel_trip, worst_by_port_and_day

SF = "/root/testdata/sf0.001"


def plain_runs(rows):
    last, out = {}, {}
    for k, t, *value in rows:
        n, before = last.get(k, (0, None))
        n += before != value
        last[k], out[(k, t)] = (n, value), n
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_number_runs(spark, partitions):
    """A key with most rows, NULL keys and values; runs that cross ranges."""
    rnd = random.Random(partitions)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3, None]), t, rnd.choice(["a", "a", "a", None]), t // 90) for t in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, v string, w int").repartition(5)
    got = number_runs(df, ["k"], ["t"], ["v", "w"], num_partitions=partitions).collect()
    assert {(r.k, r.t): r.run for r in got} == plain_runs(rows) and len(got) == len(rows)


def test_a_hot_key_is_cut_and_one_long_run_stays_one(spark):
    df = spark.createDataFrame([(1, t, "same") for t in range(2000)] + [(2, 0, "x")], "k int, t int, v string")
    dealt = ranged(df, ["k"], ["t"], 8)
    sizes = [r["count"] for r in dealt.filter("k = 1").groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 4 * sorted(sizes)[len(sizes) // 2]
    assert {r.run for r in number_runs(df, ["k"], ["t"], ["v"], num_partitions=8).select("run").distinct().collect()} == {1}
    assert number_runs(df.limit(0), ["k"], ["t"], ["v"]).count() == 0


def test_windows_are_not_over_whole_keys(spark):
    """Row windows are partitioned by range and key, and what is dealt by key alone are summary rows."""
    df = spark.createDataFrame([(1, 1, "a")], "k int, t int, v string")
    plan = number_runs(df, ["k"], ["t"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line:
            assert "_range" in line, line


def reports(spark, rows):
    return spark.createDataFrame(rows, "vessel_key long, snapshot_timestamp timestamp_ntz, departure_timestamp timestamp_ntz, "
                                 "arrival_timestamp timestamp_ntz, last_port_name string, destination_port_name string, reported_status string, n int")


def ports(spark):
    return spark.createDataFrame([(1, "Alpha", 10), (2, "Beta", 20)], "port_key long, port_name string, country_key long")


def test_trips_return_and_break(spark):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [(1, t(2), t(1), t(9), "Alpha", " beta ", "Under way", 1), (1, t(3), t(1), t(8), "Alpha", "Beta", "Moored", 2),
            (1, t(4), t(1), t(8), "Alpha", "Alpha", "Under way", 3),   # another destination
            (1, t(5), t(1), t(7), "Alpha", "BETA", "Under way", 4),    # back to the first: a new trip
            (1, t(6), None, t(7), "Alpha", "Beta", "Moored", 5),       # no departure: no trip, but an end
            (1, t(7), t(1), t(10), "Alpha", "Beta", "Under way", 6),
            (2, t(2), t(1), None, None, "Nowhere", "Moored", 7)]
    got = sorted(fact_vessel_trip(reports(spark, rows), ports(spark), ["n"]).collect(), key=lambda r: r.trip_key)
    assert [r.trip_key for r in got] == [1, 2, 3, 4, 5]
    first = got[0]
    assert (first.departure_port_key, first.destination_port_key, first.destination_country_key) == (1, 2, 20)
    assert (first.scheduled_arrival_timestamp, first.actual_arrival_timestamp) == (t(9), t(3))
    assert (first.trip_duration_hours, first.arrival_delay_hours, first.trip_status) == (48.0, -144.0, "COMPLETED")
    assert [(r.destination_port_key, r.trip_status) for r in got[1:4]] == [(1, "IN_TRANSIT"), (2, "IN_TRANSIT"), (2, "IN_TRANSIT")]
    assert (got[4].departure_port_key, got[4].destination_port_key, got[4].destination_country_key, got[4].arrival_date_key) == (-1, -1, -1, 20240102)


def test_port_risk_equals_a_theta_join(spark):
    rnd = random.Random(4)
    day = dt.date(2024, 2, 25)
    quakes = [(f"q{i}", rnd.choice([-1, 1, 1, 1, 2, 3]), day + dt.timedelta(days=rnd.randint(0, 40)), float(rnd.randint(1, 5)),
               rnd.choice(["HIGH", "MEDIUM", "LOW", "NONE"])) for i in range(120)]
    snaps = [(i, rnd.choice([1, 1, 1, 2, 3, 4, -1]), day + dt.timedelta(days=rnd.randint(-5, 50))) for i in range(300)]
    fact = spark.createDataFrame([(q, p, int(d.strftime("%Y%m%d")), km, lv) for q, p, d, km, lv in quakes],
                                 "EARTHQUAKE_KEY string, PORT_KEY long, EARTHQUAKE_DATE_KEY long, DISTANCE_KM double, RISK_LEVEL string")
    df = spark.createDataFrame([(i, 9, p, dt.datetime.combine(d, dt.time(23, 59)), 0, 0, 0) for i, p, d in snaps],
                               "vessel_snapshot_key long, vessel_key long, destination_port_key long, snapshot_timestamp timestamp_ntz, "
                               "snapshot_date_key int, snapshot_year int, snapshot_month int")
    rank = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}
    for window in (0, 1, 7, 30):
        out = fact_vessel_port_risk(df, fact, window)
        got = {r.vessel_risk_key: (r.earthquake_key, r.distance_km, r.risk_level, r.notification_required) for r in out.collect()}
        want = {}
        for i, p, d in snaps:
            met = sorted((rank[lv], km, q, lv) for q, port, on, km, lv in quakes
                         if port == p != -1 and lv in rank and d - dt.timedelta(days=window) <= on <= d)
            want[i] = (met[0][2], met[0][1], met[0][3], met[0][3] == "HIGH") if met else (None, None, "NONE", False)
        assert got == want, window
    plan = fact_vessel_port_risk(df, fact, 7)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert worst_by_port_and_day(fact).count() == len({(p, d) for _, p, d, _, lv in quakes if p != -1 and lv in rank})


def test_registered_facts_have_no_nested_loop(spark):
    for name in ("fact_vessel_trip", "fact_vessel_port_risk"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(bad in plan for bad in ("NestedLoop", "Cartesian", "PythonUDF", "ArrowEvalPython")), name


def test_earthquake_port_risk_is_numbered_in_order_of_quake_and_port(spark):
    rows = [(q, p) for q in (None, "7", "10", "9") for p in range(1, 4 if q != "9" else 2)]
    fact = spark.createDataFrame(rows[::-1], "EARTHQUAKE_KEY string, PORT_KEY long").repartition(3)
    keyed = fact_earthquake_port_risk(fact)
    got = sorted((r.earthquake_port_risk_key, r.earthquake_key, r.port_key) for r in keyed.collect())
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == [(i, *r) for i, r in enumerate(want, 1)]
    # what is ordered as a whole is a row per quake, not the fact
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "rangepartitioning(earthquake_key#" not in plan
