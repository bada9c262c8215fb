"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def with_hash(key: str):
    """A second grouping key that changes no group, but keeps the result from being laid out by ``key`` alone.

    A join on ``key`` then shuffles both of its sides, the shape in which adaptive execution splits a hot key.
    """
    return F.xxhash64(key).alias("key_hash")


def star(links: DataFrame, small: bool) -> DataFrame:
    """One step over links (a, b), a > b: every node's neighbours are tied to its smallest neighbour (or itself).

    Large steps tie the larger neighbours of a node, small steps the smaller ones and the node itself. The smallest
    neighbour is aggregated before the join, so a node with very many links costs a row per task there.
    """
    if small:
        around = links
    else:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a", with_hash("a")).agg(F.min("b").alias("least")).select("a", F.least("least", "a").alias("least"))
    if small:
        tied = around.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        tied = tied.unionByName(least.select("a", F.col("least").alias("b")))
    else:
        tied = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.where("a > b").distinct()


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node of its component.

    Links are written to the shared folder after every round, which cuts the lineage and outlives executors. Rounds go
    as the logarithm of the longest chain; links that are stars already end it.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, before = materialise(now, "links"), None
    for _ in range(most_rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if seen == before or not seen[0]:
            break
        before, now = seen, materialise(star(materialise(star(now, small=False), "links"), small=True), "links")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
