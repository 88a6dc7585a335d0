"""Connected components by alternating large-star and small-star steps on tables of edges.

Minima are aggregated with map-side combination. They go back to their edges by vertex and salt, a row for each salt
that the vertex's edges have, so a hub's edges are spread over 64 keys. Each round's edges are a table in the shared
folder; the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, free, leaf_mask, leaf_of, with_leaves


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v, m: edges with the least v of all edges of u."""
    salted = edges.withColumn("leaf", leaf_of(F.col("v")))
    least = salted.groupBy("u").agg(F.min("v").alias("m"), leaf_mask(F.col("leaf")).alias("leaves"))
    return salted.join(with_leaves(least, "leaves", "leaf"), ["u", "leaf"]).select("u", "v", "m")


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step; edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).withColumn("m", F.least("u", "m")).filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _with_least(large).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(large.groupBy("u").agg(F.min("v").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every end of an edge (a, b); component is the smallest id that is reached."""
    now = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        before, now = now, cut(_stars(now))
        free(before)
        seen = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
