"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import cut


def _digest(e: DataFrame):
    return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``edges``
    (long columns a, b).

    Alternates large-star and small-star steps: every node's larger (then
    smaller or equal) neighbours are hung on its smallest neighbour, until the
    edges are stars.  Each step is a partially aggregated minimum and a join,
    so a node with very many neighbours is split like any skewed join key.
    The edge table is cut after each round.  Self-loops and repeated edges are
    fine; an empty table gives no nodes.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, "cc")
    last = _digest(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = _digest(e)
        if now == last:
            break
        last = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
