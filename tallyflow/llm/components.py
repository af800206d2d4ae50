"""Connected components of an edge table by min-label propagation with pointer jumping.

Labels and edges stay distributed; each round is written to the shared folder, only two counters reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.frames import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns ``a`` and ``b``. Returns ``node``, ``component``: the smallest node reachable.

    Nodes without an edge do not appear; self loops, repeated and null edges count for nothing. Alternating star rounds: every
    node hooks its larger neighbours, then all its neighbours, onto the smallest one. Rows never exceed the edges, and each
    aggregate combines map-side, so a hub with a third of all edges is no single task's load.
    """
    edges = written(
        edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    total = None
    while True:
        edges = written(_small_star(_large_star(edges)), "star")
        stat = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if stat == total:
            break
        total = stat
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    joined = edges.join(least, edges.a == least.n)
    hooked = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
