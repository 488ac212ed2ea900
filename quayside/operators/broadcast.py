"""Broadcast only behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds for shipping a table to every executor.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
_ROW_BYTES = 16  # of a row besides its values
_FIXED = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.LongType: 8,
          T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``, measured in one aggregate: strings by their
    length, nested values by that of their JSON. No row leaves its task."""
    fixed, parts = _ROW_BYTES, []
    for f in df.schema.fields:
        if type(f.dataType) in _FIXED:
            fixed += _FIXED[type(f.dataType)]
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(f.name), F.lit(0)) + 8)
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) + 8)
    width = sum(parts, F.lit(fixed)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def within_bound(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         decision: bool | None = None,
                         max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(df_or_hinted_df, broadcasted)``.

    The table is hinted for broadcast only when its measured size is at most
    ``max_rows`` rows and ``max_bytes`` bytes. ``decision`` lets a
    caller reuse an earlier check (e.g. once per stream rather than per
    micro-batch). When the side is too big no hint is added; the join then
    shuffles, and AQE may still pick a broadcast from the measured size.
    """
    ok = within_bound(df, max_rows, max_bytes) if decision is None else decision
    return (F.broadcast(df) if ok else df), ok
