import datetime as dt
import random

from pyspark.sql import functions as F

from quayside.operators.metrics import last_window_distinct
from quayside.operators.scd import scd2, scd2_merge
from quayside.plans.dims import dim_date, dim_time
from quayside.plans.facts import vessel_trip


def _naive_scd2(rows):
    """Reference: last observation per day, then a new version on change."""
    daily = {}
    for k, d, v, o in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        daily[(k, d)] = v
    out, prev = [], {}
    for (k, d), v in sorted(daily.items()):
        if prev.get(k, object()) != v:
            out.append([k, v, d, None])
        prev[k] = v
    for i, row in enumerate(out):
        if i + 1 < len(out) and out[i + 1][0] == row[0]:
            row[3] = out[i + 1][2]
    return sorted(tuple(r) for r in out)


def test_scd2_cases_and_month_boundaries(spark):
    d = dt.date
    rows = [(1, d(2024, 1, 5), "A", 1), (1, d(2024, 1, 31), "A", 2),   # unchanged across the month end
            (1, d(2024, 2, 1), "B", 3),                                  # changed on the first of a month
            (1, d(2024, 3, 10), "A", 4),                                 # changed back
            (2, d(2024, 1, 1), "X", 5), (2, d(2024, 1, 1), "Y", 6),      # two changes on one date: last wins
            (3, d(2024, 4, 1), "N", 7)]                                  # new member
    df = spark.createDataFrame(rows, "k int, d date, v string, o int")
    got = sorted((r.k, r.v, r.effective_from, r.effective_to) for r in
                 scd2(df, ["k"], "d", ["v"], order=["o"]).collect())
    assert got == _naive_scd2(rows)
    cur = {r.k: r.v for r in scd2(df, ["k"], "d", ["v"], order=["o"]).filter("is_current").collect()}
    assert cur == {1: "A", 2: "Y", 3: "N"}


def test_scd2_random_equals_naive(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 4), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 120)), rnd.choice("ab"), i)
            for i in range(300)]
    df = spark.createDataFrame(rows, "k int, d date, v string, o int")
    got = sorted((r.k, r.v, r.effective_from, r.effective_to) for r in
                 scd2(df, ["k"], "d", ["v"], order=["o"]).collect())
    assert got == _naive_scd2(rows)


def test_scd2_merge_snapshot(spark):
    cur = spark.createDataFrame([
        (1, "A", dt.date(2024, 1, 1), None, True), (2, "B", dt.date(2024, 1, 1), None, True),
        (3, "C", dt.date(2024, 1, 1), None, True), (3, "c0", dt.date(2023, 1, 1), dt.date(2024, 1, 1), False)],
        "k int, v string, effective_from date, effective_to date, is_current boolean")
    snap = spark.createDataFrame([(1, "A"), (2, "B2"), (4, "D")], "k int, v string")   # 3 removed
    out = sorted(tuple(r) for r in scd2_merge(cur, snap, ["k"], ["v"], dt.date(2024, 2, 1)).collect())
    feb, jan = dt.date(2024, 2, 1), dt.date(2024, 1, 1)
    assert out == sorted([(1, "A", jan, None, True), (2, "B", jan, feb, False), (2, "B2", feb, None, True),
                          (3, "C", jan, feb, False), (3, "c0", dt.date(2023, 1, 1), jan, False),
                          (4, "D", feb, None, True)])


def test_dim_date_and_time(spark):
    dd = {r.FULL_DATE: r for r in dim_date(spark, dt.date(2024, 12, 28), dt.date(2025, 1, 5)).collect()}
    assert len(dd) == 9
    r = dd[dt.date(2024, 12, 30)]  # a Monday in ISO week 1 of 2025
    assert (r.DATE_KEY, r.DAY_OF_WEEK, r.DAY_NAME, r.WEEK_OF_YEAR, r.IS_WEEKEND, r.QUARTER, r.MONTH_NAME) == \
        (20241230, 1, "Monday", 1, False, 4, "December")
    assert dd[dt.date(2025, 1, 5)].IS_WEEKEND and dd[dt.date(2025, 1, 5)].DAY_OF_WEEK == 7
    t = dim_time(spark)
    assert t.count() == 86400
    last = t.filter("TIME_KEY = 235959").first()
    assert (last.HOUR, last.MINUTE, last.SECOND, last.HOUR_MINUTE) == (23, 59, 59, "23:59")


def test_last_window_distinct_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 50, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)), rnd.choice("xyz")) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, g string")
    got = {r.g: r.n for r in last_window_distinct(df, df, "ts", "id", "n", group_by=["g"]).collect()}
    for g in "xyz":
        m = max(t for _, t, gg in rows if gg == g)
        want = len({i for i, t, _ in rows if m - dt.timedelta(days=1) <= t <= m})
        assert got[g] == want
    overall = last_window_distinct(df, df.filter(F.col("g") == "x"), "ts", "id", "n").first().n
    assert overall == got["x"]


def test_vessel_trip(spark):
    d = dt.date
    snaps = spark.createDataFrame([
        (1, d(2024, 1, 1), d(2024, 1, 1), d(2024, 1, 10), 7), (1, d(2024, 1, 5), d(2024, 1, 1), d(2024, 1, 12), 7),
        (1, d(2024, 2, 1), d(2024, 2, 1), d(2024, 3, 1), 8)],
        "vessel_key long, snapshot_date date, departure_date date, arrival_date date, destination_port_key long")
    t = {r.destination_port_key: r for r in vessel_trip(snaps, d(2024, 2, 15)).collect()}
    assert (t[7].n_snapshots, t[7].scheduled_arrival, t[7].actual_arrival, t[7].arrival_delay_hours,
            t[7].trip_duration_hours, t[7].trip_status) == (2, d(2024, 1, 10), d(2024, 1, 12), 48, 264, "COMPLETED")
    assert t[8].trip_status == "IN_TRANSIT"


def test_scd2_from_snapshots_handles_removal_and_return(spark):
    from quayside.operators.scd import scd2_from_snapshots

    m = [dt.date(2024, i, 1) for i in range(1, 6)]
    rows = [(1, m[0], "A"), (1, m[1], "A"), (1, m[3], "A"), (1, m[4], "B"),   # missing in March, back, changed
            (2, m[0], "X"), (2, m[1], "X"), (2, m[2], "X"), (2, m[3], "X"), (2, m[4], "X"),  # unchanged
            (3, m[2], "N")]                                                     # new in March, gone in April
    df = spark.createDataFrame(rows, "k int, s date, v string")
    got = sorted((r.k, r.v, r.effective_from, r.effective_to, r.is_current)
                 for r in scd2_from_snapshots(df, ["k"], "s", ["v"]).collect())
    assert got == [(1, "A", m[0], m[2], False), (1, "A", m[3], m[4], False), (1, "B", m[4], None, True),
                   (2, "X", m[0], None, True), (3, "N", m[2], m[3], False)]


def test_incremental_and_batch_scd2_agree(spark):
    """Folding scd2_merge over the snapshots one by one gives the same history
    as scd2_from_snapshots over all of them at once."""
    from quayside.operators.scd import scd2_from_snapshots

    rnd = random.Random(11)
    months = [dt.date(2024, i, 1) for i in range(1, 6)]
    snaps = {m: {k: rnd.choice("ab") for k in range(8) if rnd.random() < 0.7} for m in months}
    schema = "k int, v string, effective_from date, effective_to date, is_current boolean"
    state = spark.createDataFrame([], schema)
    for m in months:
        snap = spark.createDataFrame(sorted(snaps[m].items()), "k int, v string")
        # small test data: materialise each step to keep the plan short
        state = spark.createDataFrame(scd2_merge(state, snap, ["k"], ["v"], m).collect(), schema)
    incremental = sorted(tuple(r) for r in state.collect())
    rows = [(k, m, v) for m in months for k, v in snaps[m].items()]
    batch = scd2_from_snapshots(spark.createDataFrame(rows, "k int, s date, v string"), ["k"], "s", ["v"])
    assert incremental == sorted(tuple(r) for r in batch.select("k", "v", "effective_from", "effective_to",
                                                                 "is_current").collect())


def test_cross_filter_shuffles_a_key_once_a_task(spark):
    from quayside.operators.metrics import cross_filter

    left = spark.createDataFrame([(i, i % 7) for i in range(50)] + [(50, None)], "v long, k long")
    right = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").union(spark.createDataFrame([(None, 1)], "k long, id long"))
    got = cross_filter(left, right, "k").select("v", "k")
    assert sorted(map(tuple, got.collect())) == [(i, i % 7) for i in range(50) if i % 7 < 3]
    lines = cross_filter(left, right.hint("merge"), "k")._jdf.queryExecution().executedPlan().toString().splitlines()
    below = lines[[i for i, x in enumerate(lines) if "LeftSemi" in x][0]:]
    assert any("HashAggregate" in x for x in below)
