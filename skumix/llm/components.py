"""Connected components by alternating large-star and small-star steps.

Every step groups edges by node, keeps the smallest neighbour (a partial
aggregate) and joins it back, so a node with a third of all edges is one
aggregate row and a skew join AQE can split; no neighbour list is ever
collected.  Each round's edges are written to the shared folder, so a lost
executor re-reads files.  Rounds grow with the logarithm of the longest
path; only two numbers a round reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge (u, v); root = smallest node.

    Self-loops, repeated and reversed edges are allowed; no edges give an
    empty result."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u <> v").distinct(), f"{name}-edges")
    before = _checksum(e)
    for i in range(max_rounds):
        if before[0] == 0:
            break
        # large star: every larger neighbour of u moves to u's smallest neighbour
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: all smaller neighbours of u, and u, move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = written(small, f"{name}-round{i}")
        after = _checksum(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components: no fixed point in {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
