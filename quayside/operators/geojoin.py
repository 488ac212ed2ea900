"""Scalable geospatial range join: points (ports) within a radius of centres
(earthquakes).

A plain theta join on a bounding box has no equi key, so Spark can only plan
it as a nested loop. Here both sides are mapped onto a latitude/longitude grid
and joined on the cell id, which Spark executes as a hash join (broadcast when
the point side has a checked bound, shuffled otherwise). The exact predicate
is applied after the equi-join, so the result equals the theta join.

Cell size is picked per centre from its radius (three levels), so a 50 km
circle touches a few 1-degree cells and a 2000 km circle some hundred 5-degree
cells; every point is placed once per level. Every (centre, point) pair is
produced at most once: a centre uses one level and its cell list is distinct.

The points of a cell are one row with an array of them, so the join finds a
cell once and a loop over the array tests its points: a test is some twenty
nanoseconds, and small cells leave 1.6 tests a pair.

The pairs outnumber both inputs, so the centres are dealt to tasks before they
are joined, by the number of pairs that will be tested (:func:`pair_tasks`),
and the pairs stay in the task that made them. What the test needs of one side
alone (box, radians, cosine) is computed once a row, before the join, and the
distance once a pair that keeps the limits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import geo
from quayside.operators.broadcast import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded,
                                          measured_size)

# (max radius km handled by the level, cell size in degrees); sizes divide 180
GRID_LEVELS = [(100.0, 1.0), (500.0, 2.5), (float("inf"), 5.0)]
CELL = "_g_cell"
# pairs tested by a task, and the most tasks that they are dealt to
PAIRS_PER_TASK = 4_000_000
MAX_TASKS = 20_000
# degrees of latitude of the rows in which centres are dealt by place
PLACE_ROWS = 20.0
# points of a cell that are one array where the points are too many to broadcast, about
POINTS_PER_PACK = 500_000


def _level_of(radius: Column) -> Column:
    expr = None
    for i, (max_r, _) in enumerate(GRID_LEVELS[:-1]):
        expr = F.when(radius <= max_r, F.lit(i)) if expr is None else expr.when(radius <= max_r, F.lit(i))
    return expr.otherwise(F.lit(len(GRID_LEVELS) - 1)) if expr is not None else F.lit(0)


def _cell_size(level: Column) -> Column:
    expr = None
    for i, (_, size) in enumerate(GRID_LEVELS):
        expr = F.when(level == i, F.lit(size)) if expr is None else expr.when(level == i, F.lit(size))
    return expr


def _rows(size: Column) -> Column:
    return (F.lit(180.0) / size).cast("int")


def _row_of(lat: Column, size: Column) -> Column:
    """Number of the row of cells; latitudes out of range are in the outermost ones."""
    return F.least(F.greatest(F.floor((lat + F.lit(90.0)) / size), F.lit(0).cast("long")), _rows(size).cast("long")).cast("int")


def _floor_idx(x: Column, offset: float, size: Column) -> Column:
    return F.floor((x + F.lit(offset)) / size).cast("int")


def _column_of(lon: Column, size: Column, mode: str) -> Column:
    """Number of the column of cells: wrapped in exact mode, else longitudes
    out of range are in the outermost ones."""
    n = _rows(size) * 2
    if mode == "exact":
        return F.pmod(_floor_idx(lon, 180.0, size), n)
    return F.least(F.greatest(F.floor((lon + F.lit(180.0)) / size), F.lit(0).cast("long")), n.cast("long")).cast("int")


def _cell(level: Column, row: Column, column: Column) -> Column:
    """Level, row and column as one long, which Spark joins faster than three keys."""
    return ((level * 1000 + row) * 1000 + column).cast("long")


def _with_angles(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Latitude, its cosine and longitude in radians, as the distance needs them."""
    return df.withColumns({f"{prefix}lat": F.radians(lat), f"{prefix}cos": F.cos(F.radians(lat)), f"{prefix}lon": F.radians(lon)})


def _with_bounds(centres: DataFrame, lat: str, lon: str, radius: str, mode: str) -> DataFrame:
    """The limits that a point has to keep: the degree box, or a band of
    latitudes a little wider than the circle."""
    if mode == "box":
        return centres.withColumns({f"_c_{k}": v for k, v in geo.bounding_box(lat, lon, radius).items()})
    ang = geo.angular_radius_deg(radius) + F.lit(1e-6)
    return centres.withColumns({"_c_lat_min": F.col(lat) - ang, "_c_lat_max": F.col(lat) + ang})


def _centre_cells(centres: DataFrame, lat: str, lon: str, radius: str, mode: str) -> DataFrame:
    """Explode each centre into the cells its candidate region touches."""
    centres = centres.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(radius).isNotNull())
    r = F.col(radius)
    level = _level_of(r)
    size = _cell_size(level)
    la, lo = F.col(lat), F.col(lon)
    if mode == "box":
        box = geo.bounding_box(la, lo, r)
        lat_lo, lat_hi = box["lat_min"], box["lat_max"]
        first = _column_of(box["lon_min"], size, mode)
        columns = F.when(box["lon_min"] <= box["lon_max"], _column_of(box["lon_max"], size, mode) - first + 1).otherwise(0)
    elif mode == "exact":
        ang = geo.angular_radius_deg(r)
        lat_lo, lat_hi = la - ang, la + ang
        half = geo.exact_lon_half_width(la, r)
        first = _floor_idx(lo - half, 180.0, size)
        columns = F.least(_floor_idx(lo + half, 180.0, size) - first + 1, _rows(size) * 2)
    else:
        raise ValueError(f"mode must be 'box' or 'exact', not {mode!r}")
    rows = F.when(lat_lo <= lat_hi, _row_of(lat_hi, size) - _row_of(lat_lo, size) + 1).otherwise(0)
    # the cells of a block of rows and columns are numbered from 0
    block = centres.withColumns({"_g_level": level, "_g_cy": _row_of(lat_lo, size), "_g_cx": first, "_g_columns": columns,
                                 "_g_n": rows * columns})
    n, width = F.col("_g_n"), F.col("_g_columns")
    cells = block.withColumn("_g_i", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    row, column = F.col("_g_cy") + F.floor(F.col("_g_i") / width).cast("int"), F.col("_g_cx") + F.col("_g_i") % width
    if mode == "exact":
        column = F.pmod(column, _rows(_cell_size(F.col("_g_level"))) * 2)
    return cells.withColumn(CELL, _cell(F.col("_g_level"), row, column)) \
        .drop("_g_level", "_g_cy", "_g_cx", "_g_columns", "_g_n", "_g_i")


def points_broadcastable(points: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """Whether the point side, once placed on every grid level, fits the
    broadcast bound (by its measured size, and the rows of its cells)."""
    rows, size = measured_size(points)
    size += 16 * rows  # the cosine, and the place in the array
    levels = len(GRID_LEVELS)
    cells = sum(int(180 / s + 1) * int(360 / s + 1) for _, s in GRID_LEVELS)
    return min(rows * levels, cells) <= max_rows and size * levels <= DEFAULT_MAX_BROADCAST_BYTES


def prepare_points(points: DataFrame, *, point_lat: str = "port_latitude", point_lon: str = "port_longitude",
                   mode: str = "box", broadcast: bool = True) -> DataFrame:
    """The point side placed on every grid level, the points of a cell as one
    array; a caller joining many batches against the same points (a stream)
    prepares this once. Points that are not to be broadcast are counted, and
    their cells cut into arrays by their number."""
    packs = 1 if broadcast else max(1, math.ceil(points.count() / POINTS_PER_PACK))
    placed = points.filter(F.col(point_lat).isNotNull() & F.col(point_lon).isNotNull()) \
        .withColumn("_g_level", F.explode(F.array(*[F.lit(i) for i in range(len(GRID_LEVELS))])))
    size = _cell_size(F.col("_g_level"))
    cell = _cell(F.col("_g_level"), _row_of(F.col(point_lat), size), _column_of(F.col(point_lon), size, mode))
    point = F.struct(*points.columns, F.cos(F.radians(point_lat)).alias("_cos"))
    pack = F.pmod(F.xxhash64(*points.columns), F.lit(packs))
    return placed.select(cell.alias(CELL), pack.alias("_g_pack"), point.alias("_g_point")) \
        .groupBy(CELL, "_g_pack").agg(F.collect_list("_g_point").alias("_g_points")).drop("_g_pack")


def pair_tasks(centres: DataFrame, prepared_points: DataFrame, *, centre_lat: str = "lat", centre_lon: str = "lon",
               radius: str = "radius_km", mode: str = "box") -> int:
    """Tasks among which to deal the centres: the pairs that share a cell, by
    counts per cell of both sides, over ``PAIRS_PER_TASK``."""
    # a file of one row group is one task: its cells are listed by as many as there are cores
    spread = centres.select(centre_lat, centre_lon, radius).repartition(centres.sparkSession.sparkContext.defaultParallelism)
    c = _centre_cells(spread, centre_lat, centre_lon, radius, mode)
    c = c.groupBy(CELL).agg(F.count(F.lit(1)).cast("double").alias("_c"))
    p = prepared_points.groupBy(CELL).agg(F.sum(F.size("_g_points")).cast("double").alias("_p"))
    tested = c.join(p, CELL).agg(F.sum(F.col("_c") * F.col("_p")).alias("n")).first()["n"] or 0.0
    return min(MAX_TASKS, max(1, math.ceil(tested / PAIRS_PER_TASK)))


def deal_by_place(centres: DataFrame, tasks: int, lat: str = "lat", lon: str = "lon", first: list[str] | None = None) -> DataFrame:
    """Ranges of ``first``, then of place, then of every other column, so that
    many centres at one place are split too. A task's pairs then hold few
    points, and an aggregate by point shrinks them before it shuffles."""
    if tasks < 2:
        return centres
    order = [*(first or []), _floor_idx(F.col(lat), 90.0, F.lit(PLACE_ROWS)), F.col(lon), F.col(lat)]
    rest = [c for c in centres.columns if c not in (lat, lon, *(first or []))]
    return centres.repartitionByRange(tasks, *order, *rest)


def geo_range_join(centres: DataFrame, points: DataFrame, *,
                   centre_lat: str = "lat", centre_lon: str = "lon", radius: str = "radius_km",
                   point_lat: str = "port_latitude", point_lon: str = "port_longitude",
                   mode: str = "box", distance_col: str = "distance_km",
                   broadcast_points: bool | None = None,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   prepared_points: DataFrame | None = None,
                   dealt: bool = False, how: str = "inner") -> DataFrame:
    """Join of centres and points with ``distance <= radius``.

    The ``between`` box test (F4) and ``distance <= radius`` (F5) are the
    exact predicate applied after the cell equi-join.

    ``mode="box"`` also requires the point to lie in the degree box of
    :func:`quayside.functions.geo.bounding_box` (the original semantics, with
    no antimeridian wrap). ``mode="exact"`` keeps every point within the
    great-circle radius, wrapping longitude and covering the poles.

    ``broadcast_points``: ``None`` checks the row bound, ``True``/``False``
    reuse a decision made by the caller. ``prepared_points`` is the output
    of :func:`prepare_points` for the same ``points`` and ``mode``.

    ``dealt`` says that the caller has dealt the centres (by
    :func:`pair_tasks`); otherwise that is done here, by place. With broadcast points the pairs keep the
    centres' partitioning. ``how="left_semi"`` returns the centres only, one
    row for each cell where one has a point in range, and stops a cell's
    search at its first.
    """
    if broadcast_points is None:
        broadcast_points = points_broadcastable(points.select(point_lat, point_lon), max_broadcast_rows)
    p = prepared_points if prepared_points is not None else \
        prepare_points(points, point_lat=point_lat, point_lon=point_lon, mode=mode, broadcast=broadcast_points)
    if not dealt:
        tasks = pair_tasks(centres, p, centre_lat=centre_lat, centre_lon=centre_lon, radius=radius, mode=mode)
        centres = deal_by_place(centres, tasks, centre_lat, centre_lon)
    columns = centres.columns
    bounded = _with_bounds(_with_angles(centres, centre_lat, centre_lon, "_c_"), centre_lat, centre_lon, radius, mode)
    c = _centre_cells(bounded, centre_lat, centre_lon, radius, mode)

    def in_bounds(lat: Column, lon: Column) -> Column:
        inside = lat.between(F.col("_c_lat_min"), F.col("_c_lat_max"))
        return inside & lon.between(F.col("_c_lon_min"), F.col("_c_lon_max")) if mode == "box" else inside

    point = F.col("_g_point")
    if how == "left_semi":  # a row a point: such a join ends at the first that is in range
        p = p.select(CELL, F.explode("_g_points").alias("_g_point")) \
            .select(CELL, point[point_lat].alias("_p_lat"), point[point_lon].alias("_p_lon"), point["_cos"].alias("_p_cos"))
        p, _ = broadcast_if_bounded(p, decision=broadcast_points)
        lat, lon = F.col("_p_lat"), F.col("_p_lon")
        dist = geo.haversine_of_angles(F.col("_c_lat"), F.col("_c_cos"), F.col("_c_lon"), F.radians(lat), F.col("_p_cos"), F.radians(lon))
        in_range = in_bounds(lat, lon) & (dist <= F.col(radius))
        return c.join(p, (c[CELL] == p[CELL]) & in_range, how).select(*columns)
    p, _ = broadcast_if_bounded(p, decision=broadcast_points)
    near = c.join(p, CELL, how).select(*[c[x] for x in c.columns], F.explode("_g_points").alias("_g_point"))
    sines = {"_s_lat": F.sin((F.radians(point[point_lat]) - F.col("_c_lat")) / 2), "_s_lon": F.sin((F.radians(point[point_lon]) - F.col("_c_lon")) / 2)}
    dist = geo.haversine_of_sines(F.col("_s_lat"), F.col("_c_cos"), F.col("_p_cos"), F.col("_s_lon"))
    # exploded, so that a filter on the distance, or on what follows from it,
    # reads the value: moved down it would compute it anew at each mention
    pairs = near.filter(in_bounds(point[point_lat], point[point_lon])) \
        .withColumns({**sines, "_p_cos": point["_cos"], **{x: point[x] for x in points.columns if x not in columns}}) \
        .select(*columns, *[x for x in points.columns if x not in columns], F.explode(F.array(dist)).alias(distance_col))
    return pairs.filter(F.col(distance_col) <= F.col(radius))


def geo_range_join_nested(centres: DataFrame, points: DataFrame, *,
                          centre_lat: str = "lat", centre_lon: str = "lon", radius: str = "radius_km",
                          point_lat: str = "port_latitude", point_lon: str = "port_longitude",
                          distance_col: str = "distance_km") -> DataFrame:
    """The original box theta join (plans as a nested-loop join).

    Kept only as the brute-force reference for tests and the benchmark.
    """
    box = geo.bounding_box(F.col(centre_lat), F.col(centre_lon), F.col(radius))
    cond = (F.col(point_lat).between(box["lat_min"], box["lat_max"])
            & F.col(point_lon).between(box["lon_min"], box["lon_max"]))
    joined = centres.join(points, cond, "inner")
    dist = geo.haversine_km(F.col(centre_lat), F.col(centre_lon), F.col(point_lat), F.col(point_lon))
    return joined.withColumn(distance_col, dist).filter(F.col(distance_col) <= F.col(radius))
