"""Connected components of a distributed edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id with an edge to another one, the smallest id it can reach.

    Each round hangs the neighbours of every id on the smallest among them, first those above the id, then those
    below, and is written to the shared folder. Rounds end when the edges are stars, after about log(longest path)
    rounds. Minima are taken in a map-side combined aggregate; only ids and minima meet in joins.
    """
    own = staged(edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = own.select("u", "v").union(own.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = staged(hung.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        state = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if state == before:
            return own.select(F.col("u").alias("id"), F.col("v").alias("component")).union(own.select(F.col("v"), F.col("v")).distinct())
        before = state
