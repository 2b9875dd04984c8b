"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.tables import written


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least one in its neighbourhood."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of those."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    across = links.join(least, "hi").where(F.col("lo") != F.col("m")).select(
        F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return across.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links(hi, lo)``; the root is the least node reachable.

    A node with very many links is only ever the key of a partial aggregate or of a join
    whose partitions can be split. Each round is written to the shared folder.
    """
    now = written(links.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo"))
                  .where("hi <> lo").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        now = written(_small_star(_large_star(now)))
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
