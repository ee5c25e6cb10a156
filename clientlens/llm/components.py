"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rounds after which something must be wrong: they grow with the logarithm of the nodes.
MOST_ROUNDS = 60


def _sum(edges: DataFrame):
    mixed = F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each node reaches: ``node``, ``root``; roots have no row of their own.

    ``links`` has the columns ``a`` and ``b``, in any direction and any number of times. Each round
    joins every link to the smallest neighbour of its ends; minima are combined before the shuffle,
    and the join's hot keys are split by adaptive execution. Rounds are cut by written tables.
    NULL ends and links of a node to itself say nothing; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    edges = materialise(edges, "links")
    before = _sum(edges)
    if not before[0]:
        return edges
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        # Larger neighbours go to the smallest one; the link to it stays with the node itself.
        large = (
            both.join(least, "node")
            .filter(F.col("root") > F.col("node"))
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .distinct()
        )
        large = materialise(large, "stars")
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").filter(F.col("root") > F.col("least"))
        small = small.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(
            least.select("node", F.col("least").alias("root"))
        )
        edges = materialise(small.distinct(), "stars")
        now = _sum(edges)
        if now == before:
            return edges
        before = now
    raise RuntimeError("components did not settle")
