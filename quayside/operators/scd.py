"""Slowly changing dimension, type 2 (D5), and run detection by key.

A per-key window (``lag`` over all rows of a key) puts a key with a third
of the data into one task. Here rows are first reduced to one per key and
day (a map-side-combined aggregate), and the ordered comparisons run inside
(key, bucket) groups -- a bucket is a calendar month by default, so a
group holds at most 31 rows. Only the bucket boundaries need a per-key pass,
over one summary row per (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.dedupe import dedupe


def _bucket_of(date_col: str, unit: str) -> Column:
    return F.trunc(F.col(date_col), unit)


def change_points(daily: DataFrame, keys: list[str], date_col: str, value_col: str,
                  unit: str = "month") -> DataFrame:
    """Rows of ``daily`` (one per key and date) whose ``value_col`` differs
    from the key's previous row; the first row of every key counts."""
    d = daily.withColumn("_b", _bucket_of(date_col, unit))
    in_bucket = Window.partitionBy(*keys, "_b").orderBy(date_col)
    d = d.withColumn("_prev", F.lag(value_col).over(in_bucket)) \
        .withColumn("_first", F.row_number().over(in_bucket) == 1)
    summary = d.groupBy(*keys, "_b").agg(F.max_by(F.col(value_col), F.col(date_col)).alias("_last"))
    by_key = Window.partitionBy(*keys).orderBy("_b")
    summary = summary.withColumn("_prev_bucket_last", F.lag("_last").over(by_key)).drop("_last")
    d = d.join(summary, [*keys, "_b"], "left")
    prev = F.when(F.col("_first"), F.col("_prev_bucket_last")).otherwise(F.col("_prev"))
    return d.filter(prev.isNull() | (prev != F.col(value_col))) \
        .drop("_prev", "_first", "_prev_bucket_last")


def next_start(rows: DataFrame, keys: list[str], date_col: str, out_col: str, unit: str = "month") -> DataFrame:
    """Add the key's next ``date_col`` (NULL for the last row), bucketed the
    same way. ``rows`` must carry ``_b`` (the bucket of ``date_col``)."""
    in_bucket = Window.partitionBy(*keys, "_b").orderBy(date_col)
    r = rows.withColumn("_next_in", F.lead(date_col).over(in_bucket))
    summary = rows.groupBy(*keys, "_b").agg(F.min(date_col).alias("_first_in"))
    by_key = Window.partitionBy(*keys).orderBy("_b")
    summary = summary.withColumn("_next_bucket_first", F.lead("_first_in").over(by_key)).drop("_first_in")
    r = r.join(summary, [*keys, "_b"], "left")
    return r.withColumn(out_col, F.coalesce(F.col("_next_in"), F.col("_next_bucket_first"))) \
        .drop("_next_in", "_next_bucket_first")


def scd2(changes: DataFrame, keys: list[str], ts: str, tracked: list[str], *,
         order: list[str] | None = None, unit: str = "month") -> DataFrame:
    """History of ``tracked`` per key from time-stamped observations.

    The last observation of each day stands for the day. A new version starts
    whenever the tracked values differ from the previous day's; versions are
    half-open ``[effective_from, effective_to)`` dates, the newest has
    ``effective_to`` NULL and ``is_current`` true.
    """
    order = list(order or [])
    obs = changes.select(*keys, *tracked, F.col(ts).alias("_ts"), *order).withColumn("_day", F.to_date("_ts"))
    daily = dedupe(obs, [*keys, "_day"], order=["_ts", *order], keep="last").select(*keys, "_day", *tracked)
    daily = daily.withColumn("_h", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
                                                 for c in tracked]))
    versions = change_points(daily, keys, "_day", "_h", unit)
    out = next_start(versions, keys, "_day", "effective_to", unit)
    return out.select(*keys, *tracked, F.col("_day").alias("effective_from"), "effective_to",
                      F.col("effective_to").isNull().alias("is_current"))


def scd2_merge(current: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
               as_of) -> DataFrame:
    """Apply one full snapshot (valid from ``as_of``) to an SCD2 table.

    Changed or removed members get their open version closed at ``as_of``;
    new and changed members get a new open version. Closed history passes
    through untouched.
    """
    as_of_col = F.lit(as_of).cast("date")
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in tracked])
    open_rows = current.filter(F.col("is_current")).withColumn("_h", h)
    closed = current.filter(~F.col("is_current"))
    snap = snapshot.select(*keys, *tracked).withColumn("_sh", h)
    j = open_rows.select(*keys, "_h").join(snap.select(*keys, "_sh"), keys, "full_outer")
    changed = j.filter(F.col("_h").isNull() | F.col("_sh").isNull() | (F.col("_h") != F.col("_sh")))
    to_close = open_rows.join(changed.filter(F.col("_h").isNotNull()).select(*keys), keys, "left_semi") \
        .withColumn("effective_to", as_of_col).withColumn("is_current", F.lit(False)).drop("_h")
    unchanged = open_rows.join(changed.select(*keys), keys, "left_anti").drop("_h")
    new_rows = snap.join(changed.filter(F.col("_sh").isNotNull()).select(*keys), keys, "left_semi") \
        .drop("_sh").withColumn("effective_from", as_of_col) \
        .withColumn("effective_to", F.lit(None).cast("date")).withColumn("is_current", F.lit(True))
    cols = current.columns
    return closed.select(*cols).unionByName(unchanged.select(*cols)).unionByName(to_close.select(*cols)) \
        .unionByName(new_rows.select(*cols))


def scd2_from_snapshots(snapshots: DataFrame, keys: list[str], snapshot_col: str, tracked: list[str],
                        order: list[str] | None = None) -> DataFrame:
    """SCD2 history from a series of FULL snapshots (every member present in
    a snapshot has one row there).

    A version starts when a member appears, re-appears after missing from a
    snapshot, or its tracked values change; it ends at the first later
    snapshot where the member is missing or changed (``effective_to``), or
    stays open (``is_current``). Several rows of one member in one snapshot
    are reduced to the last by ``order`` first. Because a member has at most
    one row per snapshot, the per-member window holds at most as many rows as
    there are snapshots; the snapshot calendar has a row per snapshot.
    """
    order = list(order or [])
    one = dedupe(snapshots.select(*keys, snapshot_col, *tracked, *order), [*keys, snapshot_col], order=order,
                 keep="last").select(*keys, snapshot_col, *tracked)
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in tracked])
    rows = one.withColumn("_h", h)
    calendar = snapshots.select(snapshot_col).distinct()  # not of the reduced rows: that would reduce them twice
    cal_order = Window.orderBy(snapshot_col)  # one row per snapshot: bounded
    calendar = calendar.select(snapshot_col, F.lag(snapshot_col).over(cal_order).alias("_gprev"),
                               F.lead(snapshot_col).over(cal_order).alias("_gnext"))
    rows = rows.join(calendar, snapshot_col)
    by_key = Window.partitionBy(*keys).orderBy(snapshot_col)
    prev_snap, prev_h = F.lag(snapshot_col).over(by_key), F.lag("_h").over(by_key)
    starts = prev_snap.isNull() | (prev_snap != F.col("_gprev")) | (prev_h != F.col("_h"))
    rows = rows.withColumn("_start", starts.cast("int"))
    rows = rows.withColumn("_version", F.sum("_start").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    versions = rows.groupBy(*keys, "_version").agg(
        F.min(snapshot_col).alias("effective_from"), F.max(snapshot_col).alias("_last"),
        F.min_by(F.struct(*tracked), F.col(snapshot_col)).alias("_t"))
    ends = calendar.select(F.col(snapshot_col).alias("_last"), F.col("_gnext").alias("effective_to"))
    out = versions.join(ends, "_last")
    return out.select(*keys, *[F.col(f"_t.{c}").alias(c) for c in tracked], "effective_from", "effective_to",
                      F.col("effective_to").isNull().alias("is_current"))
