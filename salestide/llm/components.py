"""Connected components of an undirected graph as alternating star joins.

Each round points every node at the smallest node it knows (large star, then
small star); the edges shrink towards one star per component.  Minima are
partial aggregates, joins are plain equi-joins that Spark can split where one
node has most of the edges; every round is written to the shared checkpoint
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.common import materialised


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node point at the smallest of its neighbourhood."""
    both = _both(edges)
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(low, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, point at the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): component is the
    smallest node reached.  Self-loops and repeated edges do no harm; no
    edges give no rows."""
    now = materialised(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .where(F.col("a") != F.col("b")).distinct())

    def state(df: DataFrame):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    before = state(now)
    while before[0]:
        now = materialised(_small(_large(now)))
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
