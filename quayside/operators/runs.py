"""Runs of equal values in time order (gaps and islands) without a per-key task.

``lag`` over a window of a whole key puts a key with a third of the rows into
one task. Here rows are dealt by ranges of (key, order), so such a key is cut
into several ranges; runs are found inside (range, key) groups, and one summary
row per group (its first value, last value and number of changes) carries the
count of runs on to the key's next range. The dealt rows are checkpointed in
the shared folder first, so ranges are fixed before anything is derived from
them and a lost executor cannot move a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir


def ranged(df: DataFrame, keys: list[str], order: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``_range``, the number of the row's range of (keys, order).
    Remaining columns break ties, so equal rows at most share a range."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return df.repartitionByRange(n, *keys, *order, *rest).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)


def number_runs(df: DataFrame, keys: list[str], order: list[str], values: list[str], run_col: str = "run",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``run_col``: 1 for a key's first run of equal ``values`` in ``order``,
    2 for the next, and so on. NULLs are equal to each other. ``order`` should
    be total within a key; remaining columns break its ties."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    rows = ranged(df.withColumn("_value", F.struct(*values)), keys, order, num_partitions)
    inside = Window.partitionBy("_range", *keys).orderBy(*order, *rest)
    changed = (F.row_number().over(inside) > 1) & ~F.col("_value").eqNullSafe(F.lag("_value").over(inside))
    rows = rows.withColumn("_changed", changed.cast("long")) \
        .withColumn("_changes", F.sum("_changed").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct(*order, *rest)
    groups = rows.groupBy("_range", *keys).agg(
        F.min_by("_value", at).alias("_first"), F.max_by("_value", at).alias("_last"), F.sum("_changed").alias("_inner"))
    # at most one row per range and key: the key's ranges, not its rows
    along = Window.partitionBy(*keys).orderBy("_range")
    opens = ((F.row_number().over(along) == 1) | ~F.col("_first").eqNullSafe(F.lag("_last").over(along))).cast("long")
    groups = groups.withColumn("_opens", opens)
    before = F.coalesce(F.sum(F.col("_opens") + F.col("_inner")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select(F.col("_range").alias("_of"), *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
                           (before + F.col("_opens")).alias("_base"))
    same = [rows["_range"] == groups["_of"], *[rows[k].eqNullSafe(groups[f"_key_{i}"]) for i, k in enumerate(keys)]]
    return rows.join(groups, same).select(*df.columns, (F.col("_base") + F.col("_changes")).alias(run_col))
