"""Connected components by alternating large and small stars, with each round in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.tables import removed, staged

LINK = "a long, b long"


def _stars(links: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """Hang the neighbours of each node (for a small star, the smaller ones) on the smallest node; also
    gives the table of these, which may go once the result is written."""
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("root"))
    # Written, so that the join deals both sides anew and Spark can split the links of a large star.
    least = staged(least, "least")
    near = both.join(least, "a")
    if small:
        hung = near.select(F.explode(F.array("a", "b")).alias("b"), F.col("root").alias("a"))
    else:
        hung = near.where("b > a").select("b", F.col("root").alias("a"))
    return hung.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")).distinct(), least


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node that it reaches.

    Two stars a round at most halve the depth; a round ends the work when it changes nothing.
    """
    now = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    size = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    before = None
    while True:
        large, one = _stars(now, False)
        large = staged(large, "links")
        small, two = _stars(large, True)
        old, now = now, staged(small, "links")
        removed(old, large, one, two)
        state = tuple(now.agg(F.count("*"), size).first())
        if state == before or state[0] == 0:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
