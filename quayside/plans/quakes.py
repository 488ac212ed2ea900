"""Earthquake current state and fact (P10-P14, T2 on the change schema, D6).

change messages (``CHANGE_SCHEMA``) -> typed staging rows -> latest change
per quake -> current-state table -> FACT_EARTHQUAKE with calendar keys and a
surrogate key; and the current state mapped to the archive layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.keys import date_key, time_key
from quayside.functions.parse import in_time_range
from quayside.operators.cdc import apply_changes
from quayside.operators.keys import assign_surrogate_keys

QUAKE_COLUMNS = ["unid", "source_id", "source_catalog", "lastupdate", "time", "received_at", "flynn_region",
                 "lat", "lon", "depth", "evtype", "auth", "mag", "magtype", "action", "event_date"]

# Current-state column -> archive column
ARCHIVE_RENAMES = {"time": "event_timestamp", "lat": "latitude", "lon": "longitude", "mag": "magnitude",
                   "magtype": "magnitude_type", "evtype": "event_type", "auth": "authority",
                   "event_date": "ingestion_date"}
ARCHIVE_COLUMNS = ["unid", "source_id", "event_timestamp", "flynn_region", "latitude", "longitude", "depth",
                   "magnitude", "magnitude_type", "event_type", "source_catalog", "authority", "action",
                   "received_at", "ingestion_date"]


def millis_to_time(c) -> Column:
    """Epoch milliseconds -> UTC time (exact; no trip through a double); NULL
    outside the years 1 to 9999."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(in_time_range(col), F.timestamp_millis(col)).cast("timestamp_ntz")


def stage_quake_changes(changes: DataFrame) -> DataFrame:
    """Typed staging projection of decoded change rows. ``__op`` and
    ``__ts_ms`` are kept: the sequence orders the changes and is dropped only
    after the merge has used it."""
    return changes.select(
        F.col("unid").cast("string").alias("unid"), "source_id", "source_catalog",
        millis_to_time("lastupdate").alias("lastupdate"), millis_to_time("time").alias("time"),
        millis_to_time("received_at").alias("received_at"), "flynn_region",
        *[F.col(c).cast("double").alias(c) for c in ("lat", "lon", "depth")],
        "evtype", "auth", F.col("mag").cast("double").alias("mag"), "magtype", "action",
        F.to_date(millis_to_time("time")).alias("event_date"), "__op", "__ts_ms")


def apply_quake_changes(state: DataFrame | None, staged: DataFrame, mode: str = "upsert",
                        tombstones: bool = True) -> DataFrame:
    """Fold staged changes into the current-state table keyed by ``unid``;
    the latest change per quake (by ``__ts_ms``) wins."""
    return apply_changes(state, staged, ["unid"], op="__op", seq="__ts_ms",
                         value_cols=QUAKE_COLUMNS[1:], mode=mode, tombstones=tombstones)


def fact_earthquake(quakes: DataFrame, existing_keys: DataFrame | None = None) -> DataFrame:
    """FACT_EARTHQUAKE: current quakes with year/month, the five calendar
    keys of the semantic model, the descriptive columns of the design and a
    stable surrogate key."""
    keyed = assign_surrogate_keys(quakes.select(*QUAKE_COLUMNS), existing_keys, "unid", "EARTHQUAKE_SK")
    return keyed.select(
        "EARTHQUAKE_SK", F.col("unid").alias("UNID"), F.col("time").alias("TIME"), F.col("lat").alias("LAT"),
        F.col("lon").alias("LON"), F.col("mag").alias("MAG"), F.col("event_date").alias("EVENT_DATE"),
        date_key("time").alias("TIME_DATE_KEY"), time_key("time").alias("TIME_TIME_KEY"),
        date_key("lastupdate").alias("LAST_UPDATE_DATE_KEY"), time_key("lastupdate").alias("LAST_UPDATE_TIME_KEY"),
        date_key("event_date").alias("EVENT_DATE_KEY"),
        F.col("source_id").alias("SOURCE_ID"), F.col("source_catalog").alias("SOURCE_CATALOG"),
        F.col("flynn_region").alias("FLYNN_REGION"), F.col("depth").alias("DEPTH"), F.col("magtype").alias("MAGNITUDE_TYPE"),
        F.col("evtype").alias("EVENT_TYPE"), F.col("auth").alias("AUTHORITY"), F.col("received_at").alias("RECEIVED_AT"),
        F.year("time").cast("int").alias("EVENT_YEAR"), F.month("time").cast("int").alias("EVENT_MONTH"))


def to_archive_layout(quakes: DataFrame) -> DataFrame:
    return quakes.withColumnsRenamed(ARCHIVE_RENAMES).select(*ARCHIVE_COLUMNS)
