"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours of ``u`` on the smallest of ``u`` and its neighbours.

    The smallest neighbour is a map-side combined minimum, and a node with very many
    neighbours meets it in an ordinary join, which adaptive execution splits.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = pairs.join(least, "u")
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # Each neighbour and the node itself.
        moved = joined.select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")),
        )))
    return moved.filter("u > v").distinct()


def component_roots(edges: DataFrame, name: str = "components") -> DataFrame:
    """``u, v``: for every node of an edge that is not the smallest of its component, that
    smallest node. ``edges`` has the columns ``u, v`` of one ordered type.

    Every round is stored, so a lost executor repeats one round at most. The number of rounds
    grows with the logarithm of the longest chain. No edge reaches the driver, only a checksum.
    """
    spark = edges.sparkSession
    ordered = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    now, mark = stored(spark, ordered, name), None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            return now
        mark = tuple(seen)
        large = stored(spark, _star(_neighbours(now), larger=True), name)
        now = stored(spark, _star(large, larger=False), name)
