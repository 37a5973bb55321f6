"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.session import settle


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges`` (two columns ``a``, ``b`` of longs) with its component's smallest node.

    Returns ``node``, ``label`` for nodes that have an edge. Null ends and self-loops are ignored, repeated
    edges count once, an empty table gives an empty result. Each round is two joins with map-side combined
    minima, so a hub with many neighbours is split like any skewed join; rounds grow with the logarithm of
    the longest chain. Each round's edges are written to the shared folder, in place of those of the round before.
    """
    a, b = F.col("a"), F.col("b")
    now = settle(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    mark = _fingerprint(now)
    for _ in range(max_rounds):
        now = settle(_small_star(_large_star(now)), before=now)
        seen, mark = mark, _fingerprint(now)
        if seen == mark:
            hubs = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return now.select(a.alias("node"), b.alias("label")).unionByName(hubs)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and an order-free hash of the edges."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("h"),
        F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
    ).first()
    return row.n, row.h, row.s


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )
