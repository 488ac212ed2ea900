"""Exact distinct counts under any slice, from bitmaps kept per day.

An id's dense number (W1) is a bit; a rollup row holds the bits of one slice
and day for one bucket of ids. Bitmaps merge by OR, so distinct counts of any
union of slices and days come from the rollup, without the fact, exactly.
Buckets (32,768 ids each, Spark's own layout) keep a row at 4 KB at most and
split a hot slice over tasks; a new day only adds rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.keys import dense_ids


def id_numbers(ids: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """(id_col, number): dense numbers of the distinct ids, from 1; those of
    ``known`` stay and new ids go on after them."""
    members = ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    if known is None:
        return dense_ids(members, [id_col], "number")
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("m")).first()["m"]
    fresh = dense_ids(members.join(known, id_col, "left_anti"), [id_col], "number", start=int(last) + 1)
    return known.select(id_col, "number").unionByName(fresh.select(id_col, "number"))


def bitmap_rollup(fact: DataFrame, numbers: DataFrame, id_col: str, by: list[str], flags: dict[str, Column] | None = None) -> DataFrame:
    """``by``, ``bucket`` and one bitmap per measure: ``ids`` of all rows, and
    one for the rows of each condition in ``flags``. Rows without an id count
    for nothing."""
    measures = {"ids": F.lit(True)} | (flags or {})
    rows = fact.select(*by, id_col, *[F.coalesce(c, F.lit(False)).alias(f"_{n}") for n, c in measures.items()])
    # one row per slice and id before the numbers are joined: combined on the map side
    once = rows.groupBy(*by, id_col).agg(*[F.max(f"_{n}").alias(f"_{n}") for n in measures])
    numbered = once.join(numbers, id_col)
    place = F.bitmap_bit_position(F.col("number"))
    bits = [F.bitmap_construct_agg(F.when(F.col(f"_{n}"), place)).alias(n) for n in measures]
    return numbered.groupBy(*by, F.bitmap_bucket_number(F.col("number")).alias("bucket")).agg(*bits)


def distinct_in(rollup: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Distinct ids of each group of ``by`` (a subset of the rollup's own
    columns, or none), one column per measure; filter the rollup first for a
    dashboard's slice."""
    merged = rollup.groupBy(*by, "bucket").agg(*[F.bitmap_or_agg(m).alias(m) for m in measures])
    counts = [F.coalesce(F.sum(F.bitmap_count(m)), F.lit(0)).cast("bigint").alias(m) for m in measures]
    return merged.groupBy(*by).agg(*counts) if by else merged.agg(*counts)
