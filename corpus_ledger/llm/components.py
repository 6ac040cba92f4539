"""Connected components of a large graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, written


def _settled(edges: DataFrame) -> bool:
    """Is every node either tied to one smaller node or has others tied to it, and never both?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its neighbours and itself to all larger neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node joins itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    inner = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` (``a``, ``b``), which may repeat.

    Two steps shrink the distance to the smallest node until every node is tied to it alone;
    the number of rounds grows with the logarithm of the longest path, and edges that tie every node to the smallest need
    none. The edges of each round are written, so no round depends on executors of the one before, and so is the result.
    Loops (``a = b``) are isolated nodes; NULL ends are dropped; no edges give no rows.
    """
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    now = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components"
    )
    while not _settled(now):
        before, now = now, written(_small_star(_large_star(now)), "components")
        discard(before)
    tied = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    alone = loops.join(tied.select("node").unionByName(roots.select("node")), "node", "left_anti")
    parts = written(tied.unionByName(roots).unionByName(alone.select("node", F.col("node").alias("root"))), "parts")
    discard(now)
    return parts
