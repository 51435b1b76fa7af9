"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import checkpointed


def _mark(e: DataFrame):
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (long columns a, b); root: its smallest node.

    Each round links every node's larger neighbours to the least one, then the smaller
    ones likewise; the edges end as stars after a number of rounds that grows with the
    logarithm of the size. Grouping is by min, so a hub is summed up before it is moved;
    the joins have one row per node on one side, so AQE can split a hub's edges.
    A node without links has no row; a link of a node with itself says nothing.
    """
    e = checkpointed(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct())
    seen = _mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = checkpointed(small)
        now = _mark(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
