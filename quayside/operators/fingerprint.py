"""Content fingerprints of tables: order-independent and mergeable.

A fingerprint is the number of rows and the sums of two independent 64-bit
hashes of each row, so it does not depend on order or partitioning, counts
repeated rows, and the fingerprints of parts add up to that of the whole.
Equal multisets of rows have equal fingerprints; different ones agree by
chance only (two sums of 64-bit hashes). It is one aggregate that combines on
the map side: no row is shuffled, only one line a partition value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = ["rows", "sum_a", "sum_b"]


def _canonical(df: DataFrame, columns: list[str]) -> list[Column]:
    """Values as hashed: NULL apart from every value, -0.0 as 0.0, names in
    sorted order so that column order does not count."""
    out = []
    for c in sorted(columns):
        kind = df.schema[c].dataType.simpleString()
        value = F.when(F.col(c) == 0, F.lit(0).cast(kind)).otherwise(F.col(c)) if kind in ("float", "double") else F.col(c)
        out += [F.col(c).isNull(), value]
    return out


def fingerprint(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """``by``, ``rows``, ``sum_a`` and ``sum_b`` of each group of ``by`` over
    ``columns`` (default: all others). Sums are decimals, so they are exact."""
    columns = columns or [c for c in df.columns if c not in by]
    values = _canonical(df, columns)
    hashes = {"sum_a": F.xxhash64(F.lit(1), *values), "sum_b": F.xxhash64(F.lit(2), F.reverse(F.array(*[F.xxhash64(v) for v in values])))}
    sums = [F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(n) for n, h in hashes.items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)


def merge_fingerprints(parts: DataFrame, by: list[str]) -> DataFrame:
    """Fingerprints of a coarser grouping from those of a finer one."""
    sums = [F.sum(n).cast("decimal(38,0)").alias(n) for n in SUMS[1:]]
    return parts.groupBy(*by).agg(F.sum("rows").cast("bigint").alias("rows"), *sums)


def compare_content(expected: DataFrame, actual: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per value of ``by`` in either table: its rows on both sides and
    ``status``: ``OK``, ``MISSING`` (not in ``actual``), ``EXTRA`` (not in
    ``expected``), ``ROWS`` (other number of rows) or ``CONTENT`` (as many
    rows, other values). NULL is a value of ``by`` like any other."""
    columns = columns or [c for c in expected.columns if c not in by]
    tagged = [fingerprint(df.select(*by, *columns), by, columns).withColumn("_side", F.lit(side))
              for side, df in (("expected", expected), ("actual", actual))]

    def of(side: str, name: str) -> Column:  # one line a side and group
        return F.max(F.when(F.col("_side") == side, F.col(name))).alias(f"{side}_{name}")

    both = tagged[0].unionByName(tagged[1]).groupBy(*by).agg(*[of(s, n) for s in ("expected", "actual") for n in SUMS])
    same = (F.col("expected_sum_a") == F.col("actual_sum_a")) & (F.col("expected_sum_b") == F.col("actual_sum_b"))
    status = F.when(F.col("actual_rows").isNull(), "MISSING").when(F.col("expected_rows").isNull(), "EXTRA") \
        .when(F.col("expected_rows") != F.col("actual_rows"), "ROWS").when(~same, "CONTENT").otherwise("OK")
    return both.select(*by, *[F.coalesce(f"{s}_rows", F.lit(0)).cast("bigint").alias(f"{s}_rows") for s in ("expected", "actual")],
                       status.alias("status"))
