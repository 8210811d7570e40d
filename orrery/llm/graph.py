"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours, linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node of the edges (``a``, ``b``); loops are dropped.

    Each round is written to the shared scratch folder; the number of rounds grows with the logarithm of the longest
    chain. Hub nodes meet in plain joins, which adaptive execution can split.
    """
    now = materialize(edges.toDF("a", "b").where("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == mark:
            break
        mark = (seen["n"], seen["h"])
        if not seen["n"]:
            break
        now = materialize(_small_star(_large_star(now).distinct()).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
