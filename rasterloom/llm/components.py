"""Connected components by alternating large and small stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of ``edges`` (a, b) the smallest node it can reach, except for the roots.

    Each round is written to the shared folder; only a count and a checksum reach the driver. A node with very many
    edges is grouped with partial results, and the join that brings its smallest neighbour back is one that adaptive
    execution may split.
    """
    edges = stored(_ordered(edges.select("a", "b")), "links")
    last = _sum(edges)
    while last[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _sum(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    edges = edges.where("a != b")
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    edges = _ordered(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(near.unionAll(least.select("a", F.col("m").alias("b"))))
