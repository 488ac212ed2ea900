"""Data-quality checks (Q1-Q6, A2, A16) as single-pass aggregates."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


class DataQualityError(ValueError):
    pass


def check_columns(df: DataFrame, required: list[str], allow_extra: bool = True,
                  allow_missing: bool = False) -> dict[str, list[str]]:
    """Compare column names with the spec (Q1; the missing/extra set
    difference of U4 on metadata only, no job)."""
    actual, expected = set(df.columns), set(required)
    missing, extra = sorted(expected - actual), sorted(actual - expected)
    if missing and not allow_missing:
        raise DataQualityError(f"missing required columns: {missing}")
    if extra:
        if not allow_extra:
            raise DataQualityError(f"unexpected columns: {extra}")
        log.warning("extra columns: %s", extra)
    return {"missing": missing, "extra": extra}


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one ``bigint`` NULL count per column, in a single pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long form ``(column_name, null_count)`` of :func:`null_counts`."""
    wide = null_counts(df, columns)
    return wide.unpivot([], columns, "column_name", "null_count")


def expect_not_null(df: DataFrame, columns: list[str], keep: list[str] | None = None,
                    reason_col: str = "failed_columns") -> DataFrame:
    """Rows violating NOT NULL, with the violated columns listed in spec order."""
    failed = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    out = df.withColumn(reason_col, failed).filter(F.col(reason_col) != "")
    return out.select(*(keep or df.columns), reason_col)


def raise_on_nulls(df: DataFrame, columns: list[str]) -> None:
    """Fail when any non-nullable column holds NULLs (one job for all columns)."""
    row = null_counts(df, columns).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise DataQualityError(f"NULLs in non-nullable columns: {bad}")


def with_metrics(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, "Observation"]:
    """Attach named aggregate metrics to ``df`` (default: its row count; A1,
    A17).

    The metrics are computed by whatever action runs the returned frame
    anyway (e.g. the write), instead of by one extra ``count()`` per step;
    read them afterwards with ``observation.get``. The first action that
    runs the node fills the observation, so attach it where only the
    intended action runs it (e.g. above a write's exchange).
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    exprs = [e.alias(k) for k, e in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def assert_not_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """A one-row probe (``isEmpty``), never a full count."""
    if df.isEmpty():
        raise DataQualityError(f"{what} is empty")
    return df


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """One row: expected rows, actual rows, expected keys missing from actual,
    and ``status`` (``OK`` when nothing is missing and actual >= expected)."""
    def tagged(df: DataFrame, e: int, a: int, m: int) -> DataFrame:
        return df.select(F.lit(e).alias("e"), F.lit(a).alias("a"), F.lit(m).alias("m"))

    missing = expected.select(*keys).join(actual.select(*keys), on=keys, how="left_anti")
    # one aggregate over the three tagged inputs (no join between the counts)
    row = tagged(expected, 1, 0, 0).unionByName(tagged(actual, 0, 1, 0)).unionByName(tagged(missing, 0, 0, 1)) \
        .agg(F.sum("e").cast("bigint").alias("expected_rows"), F.sum("a").cast("bigint").alias("actual_rows"),
             F.sum("m").cast("bigint").alias("missing_rows")) \
        .select(*[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
                  for c in ("expected_rows", "actual_rows", "missing_rows")])
    ok = (F.col("missing_rows") == 0) & (F.col("actual_rows") >= F.col("expected_rows"))
    return row.withColumn("status", F.when(ok, F.lit("OK")).otherwise(F.lit("FAIL")))
