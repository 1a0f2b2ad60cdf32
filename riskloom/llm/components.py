"""Connected components of a table of links, by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import staged


def _turn(edges: DataFrame) -> DataFrame:
    """From edges (high, low): every larger neighbour, then every smaller one, is tied to the smallest."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionAll(edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v <> m").select(F.col("v").alias("high"), F.col("m").alias("low"))
    return small.unionAll(least.select(F.col("u").alias("high"), F.col("m").alias("low"))).where("high <> low").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node that is linked to a smaller one; roots are the smallest of their component.

    `links` has columns a and b. The number of turns grows with the logarithm of the longest chain; no turn
    gathers the neighbours of a node in one place.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    mark = None
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("sum")).first()
        if seen == mark or not seen.n:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
        mark = seen
        edges = staged(_turn(edges), "links")
