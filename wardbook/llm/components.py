"""Connected components of a graph given as links between longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.operators.keep import keep_table


def _minimum(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _larger_to_minimum(links: DataFrame) -> DataFrame:
    """Each node hands the smallest of itself and its neighbours to its larger neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minimum(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _smaller_to_minimum(links: DataFrame) -> DataFrame:
    """Each node hands its smallest smaller neighbour to its other smaller neighbours, and keeps it itself."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minimum(down)
    handed = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Links (columns u, v) become stars round by round, each round a minimum per node and an equi-join whose skewed
    partitions Spark splits. Every round is written to the shared folder, so a lost executor costs a read. Two numbers
    come back to the driver per round. The number of rounds grows with the logarithm of the longest path (about that of the nodes
    of a component, for a path; three or four for stars and balls of near copies). An empty or self-linked input gives no rows.
    """
    now = keep_table(links.select("u", "v").filter("u <> v").distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        now = keep_table(_smaller_to_minimum(_larger_to_minimum(now)))
