"""Small-graph cross-check plans (adjacency lists), used only by tests: each
node's neighbours are collected into one array, which is fine for fixtures and
the small test graphs but not for hubs at scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.graph import canonical_edges


def neighbour_lists(pairs: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """The same sets as sorted arrays; only for graphs with bounded neighbourhoods."""
    return (pairs.groupBy(F.least(a, b).alias("node"))
            .agg(F.sort_array(F.collect_set(F.greatest(a, b))).alias("neighbours")))


def triangle_count_by_lists(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Cross-check plan with adjacency lists and ``array_intersect`` (small graphs only)."""
    ce = canonical_edges(edges, src, dst)
    both = ce.select(F.explode(F.array(F.struct(F.col("lo").alias("x"), F.col("hi").alias("y")),
                                       F.struct(F.col("hi").alias("x"), F.col("lo").alias("y")))).alias("p"))
    adj = both.groupBy(F.col("p.x").alias("v")).agg(F.collect_set("p.y").alias("nb"))
    a1 = adj.select(F.col("v").alias("lo"), F.col("nb").alias("n1"))
    a2 = adj.select(F.col("v").alias("hi"), F.col("nb").alias("n2"))
    common = ce.join(a1, "lo").join(a2, "hi").select(F.size(F.array_intersect("n1", "n2")).alias("k"))
    return common.agg((F.sum("k") / 3).cast("long").alias("triangles"))
