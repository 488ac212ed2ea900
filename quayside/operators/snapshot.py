"""Snapshot and time-slice filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.quality import DataQualityError


def latest_key(df: DataFrame, keys: list[str]) -> tuple | None:
    """The greatest value of ``keys`` (one aggregate; one row to the driver)."""
    row = df.agg(F.max(F.struct(*keys)).alias("m")).first()
    return None if row is None or row["m"] is None else tuple(row["m"])


def latest_snapshot(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows of the newest snapshot.

    The newest key is resolved first and applied as a literal filter, so on a
    table partitioned by ``keys`` only that partition is scanned.
    """
    keys = keys or ["snapshot_year", "snapshot_month"]
    latest = latest_key(df, keys)
    if latest is None:
        raise DataQualityError("no snapshots found")
    cond = None
    for k, v in zip(keys, latest):
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df.filter(cond)


def _lit_like(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(value)


def incremental_slice(df: DataFrame, column: str, after=None, up_to=None) -> DataFrame:
    """Half-open slice ``(after, up_to]``; either bound may be None."""
    cond = F.lit(True)
    if after is not None:
        cond = cond & (F.col(column) > _lit_like(after))
    if up_to is not None:
        cond = cond & (F.col(column) <= _lit_like(up_to))
    return df.filter(cond)


def apply_retention(df: DataFrame, ts: str, keep: str, as_of) -> DataFrame:
    """Keep rows newer than ``as_of - keep`` (e.g. ``keep="2 days"``).

    Rows with a NULL time stamp are kept, as a SQL ``DELETE ... WHERE ts <
    cutoff`` would keep them. ``as_of`` is an explicit parameter.
    """
    cutoff = _lit_like(as_of) - F.expr(f"INTERVAL {keep}")
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= cutoff))
