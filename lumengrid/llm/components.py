"""Connected components of a table of links, by alternating large and small stars; no node's links meet in one task's memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Links up to which the least neighbours (two rows a link at most) are broadcast.
BROADCAST_LINKS = common.BROADCAST_ROWS // 2


def _least(df: DataFrame, few: bool) -> DataFrame:
    """Broadcast, or written: a join of two tables can be split where a node has very many links."""
    return F.broadcast(df) if few else common.written(df, "least")


def _large(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = _least(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), few)
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _least(down.groupBy("u").agg(F.min("v").alias("m")), few)
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m"), F.col("u"))).where("a <> b").distinct()


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) of every node of edges (a, b); label: the least node of its component."""
    now = common.written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    few = now.count() <= BROADCAST_LINKS  # a round never adds links
    for _ in range(rounds):
        with common.tables(edges.sparkSession) as keep:
            new = common.written(_small(_large(now, few), few), "links")
            keep(new)
        common.discard(now)
        now = new
        # Done once every node hangs on one other, and on none that hangs itself.
        ends = now.select(F.col("b").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("head")).union(now.select("a", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("head").alias("head")).where("child > 1 or child = 1 and head = 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    out = now.select(F.col("b").alias("node"), F.col("a").alias("label")).union(now.select("a", "a").distinct())
    out.scratch_path = now.scratch_path
    return out
