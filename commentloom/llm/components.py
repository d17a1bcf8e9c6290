"""Connected components by alternating stars.

Each round joins every node to the smallest node around it: first its larger neighbours (large
star), then its smaller ones (small star). Rounds grow with the logarithm of the longest path.
Minima are combined ahead of the shuffle and each round is stored, so a hub is only ever a run of
narrow rows, which the skew join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from commentloom.llm.scratch import forget, stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    Edges are pairs of longs in any direction, repeats and loops allowed. A node without an edge
    to another node gives no row.
    """
    current, state = _stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    while state[0]:
        after, found = _stored(_small_star(_large_star(current)))
        forget(current)
        current = after
        if found == state:
            break
        state = found
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.distinct()
    )


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The stored edges, with their number and two checksums, taken while they are written.

    Equal states mean that a round changed nothing.
    """
    seen = Observation()
    counted = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))), F.lit(0)).alias("sum"),
    )
    table = stored(counted, "edges")
    return table, tuple(seen.get[c] for c in ("n", "mixed", "sum"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    moved = edges.join(least, "u").where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return least.select("u", F.col("_m").alias("v")).union(moved).distinct()
