"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations with a map-side step and two joins, cut by
a reliable checkpoint; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.session import cut_lineage


def _largest_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _smallest_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v: BIGINT) -> (node, root), root being the smallest node of the component.

    Only nodes with an edge to another node are returned. NULL ends and
    self loops are dropped; an empty table gives an empty result.
    """
    now = cut_lineage(edges.select("u", "v").where("u <> v").distinct())
    seen = None
    while True:
        now = cut_lineage(_smallest_star(_largest_star(now)))
        # a star forest is a fixed point: same edges, same count and checksum
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
