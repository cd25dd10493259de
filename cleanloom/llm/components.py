"""Connected components by alternating large and small stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, most: int = 100) -> DataFrame:
    """edges (a, b), long; pairs node, root for every node of an edge, root being its component's smallest node.

    In each round every edge is moved to the smallest neighbour of its ends, until nothing moves: a number of rounds
    that grows with the logarithm of the graph's width. A hub with any share of the edges is the large side of a join
    whose other side, a written table, has one row per node: adaptive execution splits it."""
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        least = stage(least, "least")  # read anew, both sides of the join are dealt by it alone, and a hub's rows can be split
        large = stage(edges.join(least, edges["b"] == least["n"]).select("a", F.col("m").alias("b")).where("a <> b").distinct(), "large")
        lower = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        met = large.join(lower, large["a"] == lower["n"]).select("a", "b", "m")
        small = met.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        moved = stage(small.where("a <> b").distinct(), "edges")
        unstage(edges, large, least)
        edges, before, mark = moved, mark, _mark(moved)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
