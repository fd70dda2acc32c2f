"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours hang on the node's smallest neighbour (or itself)."""
    both = cut(edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))),
               "cc-both")
    least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the smallest of them."""
    down = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "cc-down")
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hung.unionAll(own).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; root: the smallest node reachable.

    Rounds of large-star and small-star (about log of the longest path) run
    until nothing changes; each round is a few joins and partial aggregations
    over written tables, and the driver sees a count and a checksum. Loops and
    repeated edges are fine; nodes that only loop are not returned.
    """
    edges = cut(edges.select("u", "v").where("u is not null and v is not null and u <> v").distinct(), "cc-edges")
    before = _mark(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)), "cc-edges")
        now = _mark(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
