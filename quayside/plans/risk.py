"""Earthquake x port risk fact.

radius by magnitude -> candidate ports in range (grid join) -> distance and
level -> every quake kept (those without a port follow, with sentinels) -> the
10-column fact. Only quakes are shuffled: the pairs carry their quake's columns
through the join, so they are neither joined back nor moved, and a filter on
the fact reaches the quakes before any pair is made. The port side is
broadcast when its row count is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.dedupe import dedupe
from quayside.functions import geo
from quayside.functions.keys import date_key
from quayside.functions.numbers import concat_fixed, round_fast
from quayside.operators.geojoin import GRID_LEVELS, deal_by_place, geo_range_join, pair_tasks, points_broadcastable, prepare_points

FACT_COLUMNS = ["EARTHQUAKE_KEY", "PORT_KEY", "EARTHQUAKE_DATE_KEY", "DISTANCE_KM", "RISK_RADIUS_KM",
                "IS_NEARBY", "RISK_LEVEL", "RISK_REASON", "EVENT_YEAR", "EVENT_MONTH"]

# Sentinels written when a quake has no port in range
NO_PORT_KEY = -1
NO_DISTANCE = -1.0
NO_RADIUS = -1.0
NO_LEVEL = "NONE"
NO_REASON = "No nearby ports"

# a quake with a port this near (km) is known to have one within its radius; the first level of the grid
CLOSE_KM = GRID_LEVELS[0][0]
# tasks of pairs whose quakes are searched for ports by one task: most end at the first port
SEARCHED_BY_TASK = 8


def with_radius(quakes: DataFrame, mag: str = "mag", null_radius: int | None = geo.RADIUS_OTHERWISE) -> DataFrame:
    return quakes.withColumn("radius_km", geo.impact_radius_km(mag, null_radius))


def with_bounding_box(quakes: DataFrame, lat: str = "lat", lon: str = "lon",
                      radius: str = "radius_km") -> DataFrame:
    return quakes.withColumns(geo.bounding_box(lat, lon, radius))


def affected_pairs(quakes: DataFrame, ports: DataFrame, *, mode: str = "box",
                   null_radius: int | None = geo.RADIUS_OTHERWISE,
                   broadcast_ports: bool | None = None, prepared_ports: DataFrame | None = None,
                   dealt: bool = False) -> DataFrame:
    """(unid, port_key, distance_km, radius_km, impact_level) for every port
    in range of a quake. ``dealt``: the quakes stay in the tasks they are in."""
    centres = with_radius(quakes.select("unid", "lat", "lon", "mag"), null_radius=null_radius)
    pairs = geo_range_join(centres, ports.select("port_key", "port_latitude", "port_longitude"), mode=mode,
                           broadcast_points=broadcast_ports, prepared_points=prepared_ports, dealt=dealt)
    return pairs.select(
        "unid", "port_key", "distance_km", "radius_km",
        geo.impact_level("distance_km", "radius_km").alias("impact_level"))


def _reason_head(mag, reason_format: str):
    """The reason up to the distance, the same for all pairs of a quake."""
    if reason_format == "raw":
        return F.concat(F.lit("Earthquake of magnitude "), mag.cast("string"), F.lit(" at "))
    if reason_format == "rounded":
        return F.format_string("Earthquake of magnitude %.1f at ", mag)
    raise ValueError(f"reason_format must be 'raw' or 'rounded', not {reason_format!r}")


def _reason(head, dist, reason_format: str):
    if reason_format == "raw":
        return F.concat(head, dist.cast("string"), F.lit(" km from port"))
    return concat_fixed(head, dist, 3, " km from port")


def risk_tasks(quakes: DataFrame, prepared_ports: DataFrame, mode: str = "box",
               null_radius: int | None = geo.RADIUS_OTHERWISE) -> int:
    """Tasks among which to deal the quakes, see :func:`pair_tasks`."""
    return pair_tasks(with_radius(quakes.select("lat", "lon", "mag"), null_radius=null_radius), prepared_ports, mode=mode)


def risk_fact(quakes: DataFrame, ports: DataFrame, *, mode: str = "box",
              null_radius: int | None = geo.RADIUS_OTHERWISE, reason_format: str = "raw",
              round_digits: int | None = None, broadcast_ports: bool | None = None,
              prepared_ports: DataFrame | None = None, deal_by: str = "place") -> DataFrame:
    """Build the risk fact.

    ``quakes``: ``unid, time, lat, lon, mag``; of several rows of one ``unid``
    the latest counts (to order changes by a sequence, collapse them first,
    see :func:`quayside.operators.cdc.latest_changes`).
    ``ports``: ``port_key, port_latitude, port_longitude``.

    ``deal_by="place"`` puts quakes of one day and region in a task, for
    aggregates by port or day and for partitioned writes; ``"quake"`` puts the
    rows of an ``EARTHQUAKE_KEY`` in one task, for work by quake (with
    broadcast ports that work needs no exchange).
    """
    if deal_by not in ("place", "quake"):
        raise ValueError(f"deal_by must be 'place' or 'quake', not {deal_by!r}")
    port_cols = ports.select("port_key", "port_latitude", "port_longitude")
    if broadcast_ports is None:
        broadcast_ports = points_broadcastable(port_cols.select("port_latitude", "port_longitude"))
    if prepared_ports is None:
        prepared_ports = prepare_points(port_cols, mode=mode, broadcast=broadcast_ports)
    tasks = risk_tasks(quakes, prepared_ports, mode, null_radius)
    quakes = dedupe(quakes.select("unid", "time", "lat", "lon", "mag"), ["unid"], order=["time"])
    q = with_radius(quakes, null_radius=null_radius).select(
        F.col("unid").cast("string").alias("EARTHQUAKE_KEY"), "lat", "lon", "mag", "radius_km",
        F.to_date("time").alias("_event_date"),
        F.year("time").alias("_event_year"), F.month("time").alias("_event_month"))
    if deal_by == "place":
        dealt = deal_by_place(q, tasks, first=["_event_date"])
    else:
        q = dealt = q.repartition(tasks, "EARTHQUAKE_KEY") if tasks > 1 else q
    # what a pair has of its quake is made once a quake
    event = [date_key("_event_date", "long").alias("EARTHQUAKE_DATE_KEY"),
             F.col("_event_year").cast("int").alias("EVENT_YEAR"), F.col("_event_month").cast("int").alias("EVENT_MONTH")]
    centres = dealt.select("EARTHQUAKE_KEY", "lat", "lon", "radius_km", _reason_head(F.col("mag"), reason_format).alias("_head"), *event)
    grid = dict(mode=mode, broadcast_points=broadcast_ports, prepared_points=prepared_ports, dealt=True)
    pairs = geo_range_join(centres.filter(F.col("EARTHQUAKE_KEY").isNotNull()), port_cols, **grid)


    # quakes without a port: dealt by key, so that neither the search nor the two joins move a row again
    searched = q.repartition(-(-tasks // SEARCHED_BY_TASK), "EARTHQUAKE_KEY") if tasks > 1 and deal_by == "place" else q

    def without_port(rows: DataFrame, radius) -> DataFrame:
        near = geo_range_join(rows.select("EARTHQUAKE_KEY", "lat", "lon", radius.alias("radius_km")), port_cols, how="left_semi", **grid)
        # a quake has a row for each cell; never broadcast, as its size is not known from its table's
        return rows.join(near.select("EARTHQUAKE_KEY").distinct().hint("merge"), "EARTHQUAKE_KEY", "left_anti")

    # only those without a port close by are searched to their radius
    close = F.when(F.col("radius_km").isNotNull(), F.least(F.col("radius_km").cast("double"), F.lit(CLOSE_KM)))
    alone = without_port(without_port(searched, close), F.col("radius_km"))
    dist = F.col("distance_km")
    shown = dist.cast("double") if round_digits is None else round_fast(dist, round_digits)
    matched = pairs.select(
        "EARTHQUAKE_KEY", F.coalesce(F.col("port_key").cast("long"), F.lit(NO_PORT_KEY).cast("long")).alias("PORT_KEY"), "EARTHQUAKE_DATE_KEY",
        F.coalesce(shown, F.lit(NO_DISTANCE)).alias("DISTANCE_KM"),
        F.coalesce(F.col("radius_km").cast("double"), F.lit(NO_RADIUS)).alias("RISK_RADIUS_KM"),
        geo.is_nearby("distance_km", "radius_km").alias("IS_NEARBY"),
        geo.impact_level("distance_km", "radius_km").alias("RISK_LEVEL"),
        F.coalesce(_reason(F.col("_head"), dist, reason_format), F.lit(NO_REASON)).alias("RISK_REASON"), "EVENT_YEAR", "EVENT_MONTH")
    unmatched = alone.select(
        "EARTHQUAKE_KEY", F.lit(NO_PORT_KEY).cast("long").alias("PORT_KEY"), event[0],
        F.lit(NO_DISTANCE).alias("DISTANCE_KM"), F.lit(NO_RADIUS).alias("RISK_RADIUS_KM"),
        F.lit(False).alias("IS_NEARBY"), F.lit(NO_LEVEL).alias("RISK_LEVEL"), F.lit(NO_REASON).alias("RISK_REASON"), *event[1:])
    return matched.unionByName(unmatched)


def risk_summary(fact: DataFrame) -> DataFrame:
    """Pairs, nearby pairs and HIGH pairs in one pass (no per-count actions)."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.count_if(F.col("IS_NEARBY")).alias("nearby_pairs"),
        F.count_if(F.col("RISK_LEVEL") == "HIGH").alias("high_pairs"),
    )
