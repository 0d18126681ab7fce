"""Connected components of a graph of long ids, by alternating stars.

Large star: every node hands its larger neighbours to its smallest one. Small
star: every node links itself and its smaller neighbours to the smallest. Both
are one grouped minimum and one join; rounds go on until the edges stand still,
when every component is a star around its smallest id. Each round is written to
the shared folder, and no component or edge list reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (u, v); the component is its smallest id."""
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                    .distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are written first: a join of two plain inputs can split a hot node
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").distinct()
        # u < v in every edge: the smaller neighbours of v are its u
        large = written(large, "large-star")
        least = written(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v")
        edges = written(small.select(F.col("m").alias("u"), "v").unionByName(
            small.where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("component")))
