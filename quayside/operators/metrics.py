"""Semantic-model measures as DataFrame functions.

Every measure takes an optional ``group_by`` so it can be evaluated under
any dimension slice, as the dashboard does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from quayside.session import ensure_checkpoint_dir


def _agg(df: DataFrame, group_by, *exprs: Column) -> DataFrame:
    return df.groupBy(*group_by).agg(*exprs) if group_by else df.agg(*exprs)


def distinct_count_expr(col: str, approx: bool = False) -> Column:
    return (F.approx_count_distinct(col) if approx else F.countDistinct(col)).cast("bigint")


def distinct_where_expr(col: str, cond: Column) -> Column:
    return F.countDistinct(F.when(cond, F.col(col))).cast("bigint")


def average_expr(col: str, exclude=None) -> Column:
    return F.avg(F.col(col) if exclude is None else F.when(F.col(col) != F.lit(exclude), F.col(col)))


def measures(df: DataFrame, group_by=None, **named: Column) -> DataFrame:
    """Several measures in ONE aggregate pass, e.g.
    ``measures(fact, ["EVENT_MONTH"], nearby=distinct_where_expr(...), avg=average_expr(...))``.
    Evaluating them one by one and joining the results would scan (and
    recompute) the input once per measure."""
    return _agg(df, group_by, *[e.alias(k) for k, e in named.items()])


def distinct_count(df: DataFrame, col: str, alias: str, group_by=None, approx: bool = False) -> DataFrame:
    """Exact distinct count (Spark splits it into a (group, value) partial
    aggregate first, so a hot group is spread over its values), or the
    HyperLogLog estimate with ``approx=True``."""
    return _agg(df, group_by, distinct_count_expr(col, approx).alias(alias))


def distinct_where(df: DataFrame, col: str, cond: Column, alias: str, group_by=None) -> DataFrame:
    return _agg(df, group_by, distinct_where_expr(col, cond).alias(alias))


def average(df: DataFrame, col: str, alias: str, group_by=None, exclude=None) -> DataFrame:
    """Mean ignoring NULLs; ``exclude`` drops a sentinel value (e.g. -1.0)."""
    return _agg(df, group_by, average_expr(col, exclude).alias(alias))


def last_window_distinct(all_rows: DataFrame, filtered: DataFrame, ts: str, key: str, alias: str,
                         group_by: list[str] | None = None, width_days: int = 1, total: str | None = None) -> DataFrame:
    """Distinct ``key`` over ALL rows whose ``ts`` lies in
    ``[latest - width, latest]``, where ``latest`` is the maximum ``ts`` of
    ``filtered`` (per group when ``group_by`` is given; with ``total`` also
    over all groups, under that name in the first group column).

    The latest times are found in one pass and written to the shared folder
    (a row per group). The earliest start of a window is one value, so it
    reaches the scan of the rows as a literal filter. Each window spans at
    most ``width_days + 1`` calendar days, so windows are exploded into their
    days and equi-joined with the rows on the day, with the exact bounds
    checked after the join: no nested-loop join. A group whose window holds
    nothing still reports 0.
    """
    group_by = group_by or []
    ensure_checkpoint_dir(all_rows.sparkSession)
    latest = _agg(filtered, group_by, F.max(ts).alias("_latest"))
    if total is not None:
        whole = latest.agg(F.max("_latest").alias("_latest"))
        latest = latest.unionByName(whole.withColumns({g: F.lit(total if g == group_by[0] else None) for g in group_by}))
    latest = latest.filter(F.col("_latest").isNotNull()).checkpoint()
    lo = F.col("_latest") - F.make_dt_interval(F.lit(width_days))
    earliest = latest.agg(F.min(lo).alias("m")).first()["m"]
    windows = latest.select(*group_by, "_latest", lo.alias("_lo")) \
        .withColumn("_day", F.explode(F.sequence(F.to_date("_lo"), F.to_date("_latest"))))
    rows = all_rows.filter(F.col(ts) >= F.lit(earliest).cast(all_rows.schema[ts].dataType)) \
        .select(F.col(ts).alias("_ts"), F.col(key).alias("_key"), F.to_date(ts).alias("_day"))
    hit = rows.join(windows, "_day").filter((F.col("_ts") >= F.col("_lo")) & (F.col("_ts") <= F.col("_latest")))
    counted = _agg(hit, group_by, F.countDistinct("_key").cast("bigint").alias(alias))
    # groups whose window holds nothing still report 0
    if group_by:
        return latest.select(*group_by).join(counted, group_by, "left") \
            .select(*group_by, F.coalesce(F.col(alias), F.lit(0).cast("bigint")).alias(alias))
    return counted


def cross_filter(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` that have a match in (an already filtered) ``right``:
    a both-directions relationship propagating a filter, as a semi join.
    ``right`` is reduced to its keys in the tasks that hold it, so what is
    shuffled does not grow with its rows per key."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str, str]],
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Many-to-one left joins ``fact.fk -> dim.pk``; a dimension is broadcast
    only when its row count is within the bound."""
    out = fact
    for dim, fk, pk in dims:
        d, _ = broadcast_if_bounded(dim, max_broadcast_rows)
        out = out.join(d, out[fk] == d[pk], "left")
        if fk == pk:
            out = out.drop(d[pk])
    return out
