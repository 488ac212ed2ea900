"""Every registered workload against its DuckDB oracle on the smallest
driver tables (the driver runs the same comparison at sf0.01), plus the
entry contract and plan checks on the scalable forms."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402
from quayside import workloads  # noqa: E402

SF = "/root/testdata/sf0.001"
workloads.load_all()
NAMES = sorted(workloads.QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_workload_has_an_oracle_or_is_listed():
    assert set(NAMES) <= set(entry.queries())
    missing = set(NAMES) - set(entry.oracle_sql())
    assert missing == set(), f"workloads without an oracle: {missing}"
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_workload_matches_oracle(spark, duck, name):
    line, ok = compare(name, spark, duck, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, line


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["EARTHQUAKE_KEY", "PORT_KEY", "EARTHQUAKE_DATE_KEY", "DISTANCE_KM", "RISK_RADIUS_KM",
                          "IS_NEARBY", "RISK_LEVEL", "RISK_REASON", "EVENT_YEAR", "EVENT_MONTH"]
    assert df.count() >= 0


SCALABLE = ["risk_fact", "risk_pairs_grid", "haversine_pairs", "cdc_apply", "dedupe_latest", "scd2_history",
            "star_join", "vessel_trip", "kpi_last_24h", "location_map_detail", "seismic_flatten", "page_details",
            "listing_rows", "total_pages", "fact_earthquake", "port_dimension", "surrogate_initial", "vessel_port_risk"]


@pytest.mark.parametrize("name", SCALABLE)
def test_scalable_plans(spark, name):
    """No nested-loop join and no Python worker in the hot path."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_destinations_go_over_all_ports(spark):
    """Destinations grow with the port table."""
    sf = "/root/testdata/sf0.01"
    n = spark.read.parquet(f"{sf}/supplier.parquet").count()
    links = entry.queries()["page_details"](spark, sf).filter("destination_link <> ''").select("destination_link", "destination_port_lat").distinct()
    assert n > 30 and links.select("destination_link").distinct().count() >= 0.8 * n
    pages = {f"DEST{r.s_suppkey - 1}" for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()}
    assert all((r.destination_port_lat != "") == (r.destination_link.rsplit("/", 1)[1] in pages) for r in links.collect())
