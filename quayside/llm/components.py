"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (a, b).

    Each turn a node takes the smallest root among its neighbours' and then
    the root of that root; both steps shorten all paths, so the turns grow as
    the logarithm of the longest. Every turn is written to the shared folder;
    a hot node meets its neighbours in an aggregation with partial sums.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    roots = staged(both.groupBy("a").agg(F.min("b").alias("near"))
                   .select(F.col("a").alias("node"), F.least("a", "near").alias("root")), "roots")
    before = None
    while True:
        total = roots.agg(F.sum(F.col("root").cast("decimal(20,0)"))).first()[0]
        if total == before:
            return roots
        before = total
        near = both.join(roots.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "root")
        least = near.union(roots).groupBy("node").agg(F.min("root").alias("root"))
        # a root is a node: the root of the root so far
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = staged(least.join(up, "root", "left").select("node", F.least("root", F.coalesce("above", "root")).alias("root")), "roots")
