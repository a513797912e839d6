"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import discarded, written

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each node of an edge with the smallest node of its component: columns ``node``, ``root``.

    Alternates two joins: every node's larger neighbours are tied to its least neighbour, then its
    smaller ones, until nothing changes; the number of rounds grows with the logarithm of
    the longest chain. Only minima are aggregated, so a node with very many neighbours is never gathered in one
    place. Edges with a NULL end and loops are left out; repeated edges count once; no edges give no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    star = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        least = _both_ways(star).groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = _both_ways(star).filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        former, star = star, written(small, "edges")
        discarded(former)
        was, state = state, star.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == was:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
