"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surgewatch.llm.common import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the node's smallest neighbour (or itself)."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, hang on the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` for every node with a link; root is the smallest node.

    A node's neighbours are only aggregated and joined, never gathered; each
    round is cut in the shared checkpoint folder.  Self links and repeated
    links are ignored; nulls must be removed by the caller.  No edges: no rows.
    """
    state = lambda d: d.agg(F.count("*"), F.coalesce(F.sum(
        F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct())
    seen = state(e)
    while seen[0]:
        e = cut(_small_star(_large_star(e)))
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


__all__ = ["components"]
