"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """Per node of an edge: `node` and `component`, the smallest node it is linked to.

    `edges` has the long columns a and b. Alternates two star operations until the
    edges stay the same: larger neighbours, then smaller ones, are hung onto the
    smallest neighbour. A node's neighbours are only ever aggregated, never collected.
    """
    stars = stored(edges.filter("a <> b").select("a", "b").distinct())
    before = None
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()

        # Each node now points to smaller ones only.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        stars = stored(small)
        seen = stars.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if seen == before:
            break
        before = seen
    own = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    tops = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return own.union(tops)
