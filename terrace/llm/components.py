"""Connected components of an edge table, by alternating large and small stars until nothing changes.

Every round is two minima by key and two joins back; each round's edges are a written table, so that plans stay short
and a lost executor costs a round at most. Hub nodes are keys of joins only, which Spark splits where they are skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import written


def _stars(edges: DataFrame) -> DataFrame:
    """One round over edges u > v."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
    roots = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(roots, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(roots.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, the least node that it is connected with, for every node of an edge that isn't that least one.

    Loops, repeated edges and either direction are fine; rows with a null end count for nothing.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = written(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = seen
        now = written(_stars(now), "edges")
