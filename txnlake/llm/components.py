"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Adds m, the smallest neighbour of u.

    The minima are aggregated by task first and stored, so that the edges of a node
    with very many meet them in a plain join, which adaptive execution splits.
    """
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = _with_least(both).withColumn("m", F.least("m", "u")).filter("v > u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    rows = _with_least(edges)
    # Each edge goes to the smallest neighbour: the node itself, and its other neighbours.
    ends = F.explode(F.array("u", "v")).alias("u")
    return rows.select(ends, F.col("m").alias("v")).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """u and v: each linked node but the smallest of its component, next to the smallest one.

    `links` has u and v of any order. Large-star and small-star steps alternate
    until nothing changes; each step's edges are a stored table.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(ordered.filter("u <> v").distinct(), "links")
    seen = None
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "large-stars")), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges
        seen = now
