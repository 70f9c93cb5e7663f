"""Connected components by alternating large and small stars.

Every step is a grouped minimum and a join, so a node with very many neighbours
is summed in parts and its join partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.session import checkpoint


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b) that is not the least of its component.

    ``label`` is the component's least node. Links to oneself, repeated links
    and links with null are ignored.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = checkpoint(edges)
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = checkpoint(small.distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
