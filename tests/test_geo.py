import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from quayside.functions import geo
from quayside.operators import geojoin
from quayside.operators.geojoin import geo_range_join, geo_range_join_nested
from quayside.plans.risk import risk_fact, risk_summary, with_radius


def _hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dlat, dlon = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dlat / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dlon / 2) ** 2
    return 2 * 6371.0 * math.asin(min(math.sqrt(a), 1.0))


def _radius(m):
    if m is not None:
        for upper, r in geo.RADIUS_BANDS:
            if m < upper:
                return r
    return geo.RADIUS_OTHERWISE


def test_impact_radius_bands(spark):
    mags = [3.9, 4.0, 4.9, 5.0, 6.0, 7.0, 8.0, None]
    df = spark.createDataFrame([(m,) for m in mags], "mag double")
    got = [r[0] for r in df.select(geo.impact_radius_km("mag")).collect()]
    assert got == [50, 100, 100, 200, 500, 1000, 2000, 2000]
    keep_null = [r[0] for r in df.select(geo.impact_radius_km("mag", null_radius=None)).collect()]
    assert keep_null[-1] is None and keep_null[:-1] == got[:-1]


def test_haversine_symmetric_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 20.0, -30.0, 100.0), (5.0, 5.0, 5.0, 5.0), (None, 1.0, 2.0, 3.0)],
                               "a double, b double, c double, d double")
    r = df.select(geo.haversine_km("a", "b", "c", "d").alias("x"), geo.haversine_km("c", "d", "a", "b").alias("y")) \
        .collect()
    assert abs(r[0].x - r[0].y) < 1e-9 and abs(r[0].x - _hav(10, 20, -30, 100)) < 1e-6
    assert r[1].x == 0.0
    assert r[2].x is None


def test_impact_level_edges(spark):
    df = spark.createDataFrame([(30.0, 100.0), (60.0, 100.0), (100.0, 100.0), (None, 100.0)], "d double, r double")
    assert [x[0] for x in df.select(geo.impact_level("d", "r")).collect()] == ["HIGH", "MEDIUM", "LOW", "NONE"]


def _centres(spark, rows):
    return with_radius(spark.createDataFrame(rows, "unid long, lat double, lon double, mag double"))


def _points(spark, rows):
    return spark.createDataFrame(rows, "port_key long, port_latitude double, port_longitude double")


EDGE_CENTRES = [(1, 89.9, 10.0, 8.0), (2, -89.9, -170.0, 7.5), (3, 0.0, 179.9, 6.5), (4, 10.0, -179.9, 3.9),
                (5, 45.0, 45.0, None), (6, None, 1.0, 5.0), (7, 20.0, 30.0, 4.0)]
EDGE_POINTS = [(1, 89.0, -170.0), (2, -89.0, 10.0), (3, 0.0, -179.9), (4, 10.0, 179.95), (5, 45.0, 45.0),
               (6, 20.0, 30.0), (7, 20.2, 30.2), (8, 0.0, 0.0), (9, 44.0, 60.0)]


def test_grid_box_join_equals_nested_loop(spark):
    c, p = _centres(spark, EDGE_CENTRES), _points(spark, EDGE_POINTS)
    grid = {(r.unid, r.port_key) for r in geo_range_join(c, p, mode="box").collect()}
    nested = {(r.unid, r.port_key) for r in geo_range_join_nested(c, p).collect()}
    assert grid == nested and (5, 5) in grid and (7, 6) in grid


def test_exact_join_equals_brute_force_with_wrap_and_poles(spark):
    c, p = _centres(spark, EDGE_CENTRES), _points(spark, EDGE_POINTS)
    got = {(r.unid, r.port_key) for r in geo_range_join(c, p, mode="exact").collect()}
    want = set()
    for u, la, lo, m in EDGE_CENTRES:
        if la is None:
            continue
        r = _radius(m)
        for k, pla, plo in EDGE_POINTS:
            if _hav(la, lo, pla, plo) <= r:
                want.add((u, k))
    assert got == want
    # across the antimeridian and over the pole
    assert (3, 3) in got and (4, 4) in got and (1, 1) in got


coords = st.tuples(st.floats(-89.99, 89.99), st.floats(-179.99, 179.99))


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.tuples(coords, st.sampled_from([3.0, 4.5, 5.5, 6.5, 7.5, 8.5])), min_size=1, max_size=12),
       st.lists(coords, min_size=1, max_size=25))
def test_grid_join_property(spark, centres, points):
    c = _centres(spark, [(i, la, lo, m) for i, ((la, lo), m) in enumerate(centres)])
    p = _points(spark, [(i, la, lo) for i, (la, lo) in enumerate(points)])
    grid = {(r.unid, r.port_key) for r in geo_range_join(c, p, mode="box").collect()}
    nested = {(r.unid, r.port_key) for r in geo_range_join_nested(c, p).collect()}
    assert grid == nested
    exact = {(r.unid, r.port_key) for r in geo_range_join(c, p, mode="exact").collect()}
    brute = {(r.unid, r.port_key) for r in c.crossJoin(p).withColumn(
        "d", geo.haversine_km("lat", "lon", "port_latitude", "port_longitude")).filter("d <= radius_km").collect()}
    assert exact == brute


def test_grid_plan_has_no_nested_loop_or_python(spark):
    c, p = _centres(spark, EDGE_CENTRES), _points(spark, EDGE_POINTS)
    plan = geo_range_join(c, p)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_risk_fact_sentinels_and_summary(spark):
    q = spark.createDataFrame([Row(unid=1, time=None, lat=20.0, lon=30.0, mag=5.0),
                               Row(unid=2, time=None, lat=-60.0, lon=-120.0, mag=3.0)],
                              "unid long, time timestamp_ntz, lat double, lon double, mag double")
    q = q.withColumn("time", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    p = _points(spark, [(10, 20.0, 30.0), (11, 20.5, 30.5), (12, 0.0, 0.0)])
    fact = risk_fact(q, p)
    rows = {(r.EARTHQUAKE_KEY, r.PORT_KEY): r for r in fact.collect()}
    assert rows[("1", 10)].DISTANCE_KM == 0.0 and rows[("1", 10)].RISK_LEVEL == "HIGH"
    assert rows[("1", 10)].EARTHQUAKE_DATE_KEY == 20240102 and rows[("1", 10)].RISK_REASON.startswith("Earthquake")
    none = rows[("2", -1)]
    assert (none.DISTANCE_KM, none.RISK_RADIUS_KM, none.IS_NEARBY, none.RISK_LEVEL, none.RISK_REASON) == \
        (-1.0, -1.0, False, "NONE", "No nearby ports")
    s = risk_summary(fact).first()
    assert (s.total_pairs, s.nearby_pairs, s.high_pairs) == (3, 2, 1)


def test_risk_fact_null_coordinates_keep_one_sentinel_row(spark):
    q = spark.createDataFrame([(7, None, 10.0, 6.0), (8, 20.0, None, 6.0)], "unid long, lat double, lon double, mag double") \
        .withColumn("time", F.lit("2024-03-04 00:00:00").cast("timestamp_ntz"))
    p = _points(spark, [(10, 20.0, 30.0), (11, 0.0, 10.0)])
    rows = [(r.EARTHQUAKE_KEY, r.PORT_KEY, r.RISK_LEVEL) for r in risk_fact(q, p).collect()]
    assert sorted(rows) == [("7", -1, "NONE"), ("8", -1, "NONE")]


def test_centres_of_one_partition_are_dealt_by_the_pairs_they_test(spark, monkeypatch):
    monkeypatch.setattr(geojoin, "PAIRS_PER_TASK", 50)
    c = _centres(spark, [(i, float(i % 60), float(i % 90), 7.5) for i in range(200)]).coalesce(1)
    p = _points(spark, [(i, float(i % 50), float(i % 80)) for i in range(40)])
    for mode in ("box", "exact"):
        joined = geo_range_join(c, p, mode=mode)
        assert joined.rdd.getNumPartitions() > 20
        got = sorted((r.unid, r.port_key) for r in joined.collect())
        assert len(got) == len(set(got))
        if mode == "box":
            assert got == sorted((r.unid, r.port_key) for r in geo_range_join_nested(c, p).collect())
    near = geo_range_join(c, p, mode="exact", how="left_semi")
    assert {r.unid for r in near.collect()} == {u for u, _ in got} and near.columns == c.columns


def _above(plan: str, mark: str) -> list[list[str]]:
    """The operators above each line of a plan's tree that holds ``mark``."""
    lines = [(len(x) - len(x.lstrip(" +-:")), x.lstrip(" +-:")) for x in plan.splitlines()]
    found = []
    for i, (depth, text) in enumerate(lines):
        if mark in text:
            above = []
            for d, t in reversed(lines[:i]):
                if d < depth:
                    above.append(t)
                    depth = d
            found.append(above)
    return found


def test_pairs_of_the_risk_fact_are_neither_shuffled_nor_joined_back(spark):
    q = spark.createDataFrame([Row(unid=i, time=dt.datetime(2024, 1, 1 + i % 28), lat=float(i % 60), lon=float(i % 90), mag=5.5)
                               for i in range(100)])
    p = _points(spark, [(i, float(i % 50), float(i % 80)) for i in range(40)])
    for opts in ({}, {"deal_by": "quake"}):
        fact = risk_fact(q, p, **opts)
        above = _above(fact._jdf.queryExecution().executedPlan().toString(), "Inner, BuildRight")
        assert len(above) == 1 and not [t for t in above[0] if "Exchange" in t or "Join" in t]
        keys = [r.EARTHQUAKE_KEY for r in fact.collect()]
        assert set(keys) == {str(i) for i in range(100)} and len(keys) > 100


def test_a_filter_on_the_level_does_not_compute_the_distance_anew(spark):
    q = spark.createDataFrame([Row(unid=i, time=dt.datetime(2024, 1, 1 + i % 28), lat=float(i % 60), lon=float(i % 90), mag=5.5)
                               for i in range(100)])
    p = _points(spark, [(i, float(i % 50), float(i % 80)) for i in range(40)])
    fact = risk_fact(q, p)
    high = fact.filter(F.col("RISK_LEVEL") == "HIGH")
    plan = high._jdf.queryExecution().executedPlan().toString()
    # once for the pairs; the semi join that finds quakes without a port is not part of a HIGH row
    assert plan.count("ASIN(") == 1 and "Generate explode(array(" in plan
    want = sorted((r.EARTHQUAKE_KEY, r.PORT_KEY) for r in fact.collect() if r.RISK_LEVEL == "HIGH")
    assert want and sorted((r.EARTHQUAKE_KEY, r.PORT_KEY) for r in high.collect()) == want


def test_points_and_boxes_out_of_range_equal_the_nested_loop(spark):
    c = _centres(spark, [(1, 10.0, 179.5, 6.5), (2, 89.0, 0.0, 7.5), (3, -10.0, -179.0, 8.5), (4, 5.0, 182.0, 5.5), (5, 1.0, 2.0, 3.0)])
    p = _points(spark, [(1, 10.0, 181.0), (2, 90.5, 10.0), (3, -10.0, -181.5), (4, 5.5, 182.5), (5, 5.0, 184.0), (6, 1.2, 2.1), (7, None, 2.0), (8, 1.0, None)])
    grid = {(r.unid, r.port_key) for r in geo_range_join(c, p, mode="box").collect()}
    assert grid == {(r.unid, r.port_key) for r in geo_range_join_nested(c, p).collect()}
    assert {(1, 1), (3, 3), (4, 4), (5, 6)} <= grid


def test_points_of_a_cell_are_one_row_or_few_where_they_are_many(spark, monkeypatch):
    c = _centres(spark, [(i, 10.0 + i / 10, 20.0, 6.0 + i % 3) for i in range(20)])
    p = _points(spark, [(i, 10.0 + i / 1000, 20.0 + i / 1000) for i in range(300)])
    want = sorted((r.unid, r.port_key) for r in geo_range_join_nested(c, p).collect())
    prepared = geojoin.prepare_points(p)
    assert prepared.count() <= 3 and prepared.agg(F.sum(F.size("_g_points"))).first()[0] == 900
    monkeypatch.setattr(geojoin, "POINTS_PER_PACK", 20)
    cut = geojoin.prepare_points(p, broadcast=False)
    assert cut.agg(F.max(F.size("_g_points"))).first()[0] < 60
    for given in ({"broadcast_points": True, "prepared_points": prepared}, {"broadcast_points": False}):
        assert sorted((r.unid, r.port_key) for r in geo_range_join(c, p, **given).collect()) == want


def test_what_a_pair_has_of_its_quake_is_made_before_the_join(spark):
    q = spark.createDataFrame([Row(unid=i, time=dt.datetime(2024, 1, 1 + i % 28), lat=float(i % 60), lon=float(i % 90), mag=5.5 + i % 3)
                               for i in range(100)] + [Row(unid=100, time=dt.datetime(2024, 2, 1), lat=0.0, lon=0.0, mag=None)])
    p = _points(spark, [(i, float(i % 50), float(i % 80)) for i in range(40)])
    fact = risk_fact(q, p, reason_format="rounded", round_digits=6)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    above = _above(plan, "format_string(Earthquake of magnitude %.1f at , mag")
    assert above and all("Join" in " ".join(x) for x in above)
    rows = risk_fact(q, p).join(q.select(F.col("unid").cast("string").alias("EARTHQUAKE_KEY"), "mag"), "EARTHQUAKE_KEY").filter("PORT_KEY >= 0") \
        .select("EARTHQUAKE_KEY", "PORT_KEY", F.round("DISTANCE_KM", 6).alias("d"),
                F.format_string("Earthquake of magnitude %.1f at %.3f km from port", "mag", "DISTANCE_KM").alias("t")).collect()
    got = fact.filter("PORT_KEY >= 0").select("EARTHQUAKE_KEY", "PORT_KEY", F.col("DISTANCE_KM").alias("d"), F.col("RISK_REASON").alias("t")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows)) and any(r.EARTHQUAKE_KEY == "100" for r in got)


def test_a_quake_whose_ports_are_all_far_is_not_alone(spark):
    q = spark.createDataFrame([Row(unid=i, time=dt.datetime(2024, 1, 1), lat=0.0, lon=10.0 * i, mag=m) for i, m in enumerate([8.5, 3.0, 7.5, 6.5])])
    p = _points(spark, [(1, 0.0, 15.0), (2, 0.0, 20.3)])
    for opts in ({}, {"deal_by": "quake"}, {"broadcast_ports": False}):
        rows = {(r.EARTHQUAKE_KEY, r.PORT_KEY) for r in risk_fact(q, p, **opts).collect()}
        assert rows == {("0", 1), ("1", -1), ("2", 1), ("2", 2), ("3", -1)}
