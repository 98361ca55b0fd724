"""Connected components of a table of links, by alternating star contraction.

Each round points all greater neighbours of a node at its least neighbour (large star), then the
lesser ones (small star), until every link points at the least node of its component. Rows never
multiply, a node's links are never gathered, and each round is written to the shared folder.

Edge cases: null ends and links of a node with itself are dropped, repeated links count once, no
links give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.base import store


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.filter("b < a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("low").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that links reach, for every node with a link."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = store(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "links")
    for _ in range(max_rounds):
        low = links.groupBy("a").agg(F.countDistinct("b").alias("n"))
        loose = low.filter("n > 1").limit(1).count()
        if not loose and not links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count():
            roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        links = store(_star(_star(links, True), False), "links")
    raise RuntimeError("components did not settle")
