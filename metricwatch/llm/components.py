"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Each step is two aggregations and a join on node ids, so no node's links ever meet in one task as a
group: a hub is a hot join key, which adaptive execution splits. The number of links never grows.
Every round is written to the shared checkpoint folder; lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the least node among it and its neighbours."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to its least neighbour. Links have v < u."""
    least = links.groupBy("u").agg(F.min("v").alias("low"))
    moved = links.join(least, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(least.select("u", F.col("low").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    """One row that differs, in practice, whenever the links differ."""
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).head())


def components(links: DataFrame) -> DataFrame:
    """links (u, v), any order, repeats and loops allowed -> (node, component): the least node reachable.

    Nodes without a link to another node don't appear. Nulls never link.
    """
    a, b = links.columns[:2]
    now = checkpoint(links.where(F.col(a) != F.col(b))
                     .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _state(now)
    while True:
        now = checkpoint(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    return now.unionAll(now.select("v", "v").toDF("u", "v").distinct()).toDF("node", "component")
