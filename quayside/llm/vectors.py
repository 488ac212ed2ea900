"""Tables of vectors: validity, sharding and the last merge of a search."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, dim int, vec array<double>), one row per id.

    Rows with a null id, a null or empty vector, or a null or non-finite
    component take no part. Of several vectors under one id the smallest (in
    Spark's order of arrays) counts.
    """
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite) \
        .groupBy("id").agg(F.min("vec").alias("vec")).select("id", F.size("vec").alias("dim"), "vec")


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def block_of(id_col: str, blocks: int, seed: int) -> Column:
    """A block number by a hash of the id."""
    return F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(blocks)).cast("int")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k largest scores of each query, ties to the smaller vec_id, ranked
    from 1. ``found`` has each candidate once."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
