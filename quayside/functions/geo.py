"""Native column expressions for the seismic-risk model.

All of these compile to JVM expressions inside whole-stage codegen; there is
no Python worker on the data path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they define the model and must not drift):
#   magnitude upper bounds -> impact radius in km:
#     below 4.0 -> 50, below 5.0 -> 100, below 6.0 -> 200, below 7.0 -> 500,
#     below 8.0 -> 1000, anything else (including a missing magnitude) -> 2000
#   earth radius 6371 km; one degree of latitude taken as 111.0 km
#   impact level: distance <= 0.3 * radius HIGH, <= 0.6 * radius MEDIUM, else LOW,
#     and NONE when no port is in range
RADIUS_BANDS = [(4.0, 50), (5.0, 100), (6.0, 200), (7.0, 500), (8.0, 1000)]
RADIUS_OTHERWISE = 2000
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0
HIGH_SHARE = 0.3
MEDIUM_SHARE = 0.6
MAX_RADIUS_KM = max([r for _, r in RADIUS_BANDS] + [RADIUS_OTHERWISE])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def impact_radius_km(mag, null_radius: int | None = RADIUS_OTHERWISE) -> Column:
    """Radius of concern by magnitude (int).

    A NULL magnitude falls through every band to the last value, as in the
    original job; pass ``null_radius=None`` to keep it NULL instead.
    """
    m = _c(mag)
    expr = None
    for upper, radius in RADIUS_BANDS:
        expr = F.when(m < upper, F.lit(radius)) if expr is None else expr.when(m < upper, F.lit(radius))
    expr = expr.otherwise(F.lit(RADIUS_OTHERWISE))
    if null_radius != RADIUS_OTHERWISE:
        expr = F.when(m.isNull(), F.lit(null_radius).cast("int")).otherwise(expr)
    return expr


def bounding_box(lat, lon, radius_km) -> dict[str, Column]:
    """Degree box around a point: +-r/111 in latitude, +-r/(111 cos lat) in
    longitude. No wrapping at the antimeridian or poles (parity form)."""
    la, lo, r = _c(lat), _c(lon), _c(radius_km)
    dlat = r / F.lit(KM_PER_DEGREE)
    dlon = r / (F.lit(KM_PER_DEGREE) * F.cos(F.radians(la)))
    return {
        "lat_min": la - dlat,
        "lat_max": la + dlat,
        "lon_min": lo - dlon,
        "lon_max": lo + dlon,
    }


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; NULL if any input is NULL."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    l1, l2 = F.radians(_c(lon1)), F.radians(_c(lon2))
    given = p1.isNotNull() & p2.isNotNull() & l1.isNotNull() & l2.isNotNull()
    return F.when(given, haversine_of_angles(p1, F.cos(p1), l1, p2, F.cos(p2), l2))


def haversine_of_angles(lat1: Column, cos1: Column, lon1: Column, lat2: Column, cos2: Column, lon2: Column) -> Column:
    """The same from angles in radians and the cosines of the latitudes, which
    a join computes once a row and not once a pair. No input may be NULL."""
    return haversine_of_sines(F.sin((lat2 - lat1) / 2), cos1, cos2, F.sin((lon2 - lon1) / 2))


def haversine_of_sines(half_lat: Column, cos1: Column, cos2: Column, half_lon: Column) -> Column:
    """The same from the sines of half the differences, each mentioned twice: a
    square is a product, as Spark's ``pow`` takes longer than a sine."""
    a = half_lat * half_lat + cos1 * cos2 * (half_lon * half_lon)
    # clamp a rounding overshoot above 1.0 for asin; unlike when(), least()
    # names the root, and so the sines, once
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def impact_level(distance_km, radius_km) -> Column:
    d, r = _c(distance_km), _c(radius_km)
    return (F.when(d.isNull(), F.lit("NONE"))
            .when(d <= r * HIGH_SHARE, F.lit("HIGH"))
            .when(d <= r * MEDIUM_SHARE, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def is_nearby(distance_km, radius_km) -> Column:
    return F.coalesce(_c(distance_km) <= _c(radius_km), F.lit(False))


def angular_radius_deg(radius_km) -> Column:
    """Radius as a central angle in degrees (exact form)."""
    return F.degrees(_c(radius_km) / F.lit(EARTH_RADIUS_KM))


def exact_lon_half_width(lat, radius_km) -> Column:
    """Half-width in longitude (degrees) of the smallest band containing a
    spherical cap, or 180 when the cap contains a pole."""
    la = F.radians(_c(lat))
    ang = _c(radius_km) / F.lit(EARTH_RADIUS_KM)
    ratio = F.sin(ang) / F.cos(la)
    reaches_pole = (F.abs(_c(lat)) + F.degrees(ang)) >= F.lit(90.0)
    return F.when(reaches_pole | (ratio >= 1.0), F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)))
