"""Connected components by alternating large-star and small-star rounds.

Every round regroups the links and is written once, so no links reach the driver and a
lost executor re-reads the last round. The rounds needed grow with the logarithm of the
longest chain of links.

The smallest node of a large component is linked to all its nodes. A node with more than a
``HUBS``-th of all ends of links is a hub and joined by a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import HUBS, join_hubs
from breachline.settings import cut


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.inline(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
    )))


def _large_star(links: DataFrame, crowd: float) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node it knows."""
    near = _both_ways(links)
    least = near.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")
    )
    return (
        join_hubs(near.where("v > u"), least, ["u"], F.col("n"), crowd)
        .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    )


def _small_star(links: DataFrame, crowd: float) -> DataFrame:
    """Link a node's smaller neighbours and itself to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_hubs(down, least, ["u"], F.col("n"), crowd).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, hubs: int = HUBS) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; ``root`` is its smallest node.

    Self links and repeated links change nothing; no links give no rows.
    """
    links = cut(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b").distinct(), "links",
    )
    state = _state(links)
    while True:
        crowd = 2 * state[0] / hubs
        links = cut(_small_star(cut(_large_star(links, crowd), "links"), crowd), "links")
        before, state = state, _state(links)
        if before == state:
            break
    nodes = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)
