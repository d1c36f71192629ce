"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are a grouped minimum (aggregated partially before the shuffle) and a join back,
so a node with very many neighbours is split by adaptive execution. Every step is written
to the shared checkpoint folder; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import discard, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest node around them: larger ones (large) or the rest (small)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges  # u > v throughout
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for each node of an edge, the smallest node it can reach.

    Self-loops and repeated edges are ignored; an empty table gives an empty result. Nodes
    without edges do not appear. ``a`` and ``b`` are long and not NULL.
    """
    spark, held = edges.sparkSession, []
    edges = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges", held)
    seen = _print(edges)
    while seen[0]:
        past, held = held, []
        edges = stage(_star(stage(_star(edges, True), "large", past), False), "small", held)
        discard(spark, past)  # all but the last step's table
        now = _print(edges)
        if now == seen:
            break
        seen = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
