"""Neighbour sets, two-hop links and triangles over edge DataFrames
(inventory C8, D3, D4, E13, E15, E16, H2, H3, I24).

Neighbourhoods are kept as rows or in sorted blocks of bounded size, never
collected into one array per node: a hub's neighbour list grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import global_rank
from quarry.session import write_scratch


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph: self-loops dropped, each edge once as (lo < hi)."""
    return (edges.where(F.col(src) != F.col(dst))
            .select(F.least(src, dst).alias("lo"), F.greatest(src, dst).alias("hi"))
            .distinct())


def neighbour_sets(pairs: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Each pair filed under its smaller id; one row per (node, neighbour) with the
    node's neighbour count, so a hub never becomes one collected row.
    """
    nb = pairs.select(F.least(a, b).alias("node"), F.greatest(a, b).alias("neighbour")).distinct()
    deg = nb.groupBy("node").agg(F.count(F.lit(1)).alias("n_neighbours"))
    return nb.join(deg, "node")


HEAVY_PAIRS = 1 << 22   # (in, out) pairs of a middle node that are still joined as rows
CELL_PAIRS = 1 << 19    # pairs of a middle node that are joined in one piece, about
TASK_PAIRS = 1 << 20    # pairs that one task joins, on average
HUB_PAIRS = 1 << 23     # pairs through hubs that one task takes as bitmaps, on average
HUB_BYTES = 1 << 26     # and the bitmaps' bytes
CHUNK = 1 << 15         # bits of the engine's bitmaps


def two_hop_links(edges: DataFrame, src: str = "src", dst: str = "dst", heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """Distinct (a, c) with a -> b -> c and c != a, over distinct directed edges. Runs jobs.

    A middle node b with few (in, out) pairs gives them as rows, in tasks of
    about ``TASK_PAIRS`` pairs however many edges there are: a task's distinct
    links are held in its memory. A hub does not:
    its out-neighbours, numbered densely over all hubs, are bitmaps of
    ``CHUNK`` numbers, each a gets those of its hubs, and ``or`` over the
    bitmaps makes an a's links through all hubs distinct before any of them is
    a row. So in x out / 8 bytes are shuffled for a hub instead of in x out
    rows; what remains are the links themselves.
    """
    e = write_scratch(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
                      .select(F.col(src).alias("s"), F.col(dst).alias("d")).distinct(), "edges")
    first = e.select(F.col("s").alias("a"), F.col("d").alias("b"))
    second = e.select(F.col("s").alias("b"), F.col("d").alias("c"))
    n_in = first.groupBy("b").agg(F.count(F.lit(1)).alias("n_in"))
    n_out = second.groupBy("b").agg(F.count(F.lit(1)).alias("n_out"))
    middle = write_scratch(n_in.join(n_out, "b").select("b", (F.col("n_in") * F.col("n_out")).alias("pairs")), "middle-nodes")
    heavy = F.col("pairs") > heavy_pairs
    found = middle.agg(F.count_if(heavy).alias("hubs"), F.sum(F.when(~heavy, F.col("pairs"))).alias("pairs")).first()
    light = _links(first, second, middle.where(~heavy), found["pairs"] or 0)
    if not found["hubs"]:
        return light.distinct()
    hubs = middle.where(heavy).select("b")
    through = hub_links(first.join(hubs, "b", "left_semi"), second.join(hubs, "b", "left_semi"))
    return light.unionByName(through).distinct() if found["pairs"] else through


def _links(first: DataFrame, second: DataFrame, middle: DataFrame, pairs: int) -> DataFrame:
    """(a, c) through the nodes of ``middle``, which have so many pairs in all: each node's in cells of a share of its
    in-edges with all its out-edges, the cells spread over tasks by the number of pairs."""
    tasks = max(1, -(-pairs // TASK_PAIRS))
    cells = middle.select("b", F.ceil(F.col("pairs") / CELL_PAIRS).cast("int").alias("cells"))
    ins = first.join(cells, "b").select("a", "b", F.pmod(F.xxhash64("a"), "cells").cast("int").alias("cell"))
    outs = second.join(cells, "b").select("b", "c", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
    joined = ins.repartition(tasks, "b", "cell").join(outs.repartition(tasks, "b", "cell"), ["b", "cell"])
    return joined.where(F.col("c") != F.col("a")).select("a", "c")


def hub_links(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct (a, c) over ``first`` (a, b) and ``second`` (b, c), distinct by bitmaps. Runs jobs.

    Bitmaps end with their last set byte, so a hub with few out-neighbours is
    a few bytes for each a. They are sorted by (a, chunk) in tasks of about
    ``HUB_BYTES`` and ``HUB_PAIRS`` pairs, whose links are held in memory.
    """
    numbered = global_rank(second.select("c").distinct(), ["c"], "rank").select(
        "c", F.expr(f"(rank - 1) div {CHUNK}").alias("chunk"), ((F.col("rank") - 1) % CHUNK).alias("bit"))
    names = numbered.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("bit", "c"))), lambda x: x["c"]).alias("cs"))
    last = F.floor(F.max("bit") / 8).cast("int") + 1
    outs = (second.join(numbered, "c").groupBy("b", "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"), last.alias("octets"), F.count(F.lit(1)).alias("n_out"))
            .select("b", "chunk", F.substring("bits", F.lit(1), F.col("octets")).alias("bits"), "octets", "n_out"))
    outs = write_scratch(outs, "hub-bitmaps")
    sizes = outs.groupBy("b").agg(F.sum(F.col("octets") + 64).alias("bytes"), F.sum("n_out").alias("n_out"))
    size = (first.groupBy("b").agg(F.count(F.lit(1)).alias("n_in")).join(sizes, "b")
            .agg(F.sum(F.col("n_in") * F.col("bytes")).alias("bytes"), F.sum(F.col("n_in") * F.col("n_out")).alias("pairs")).first())
    tasks = max(1, -(-(size["bytes"] or 0) // HUB_BYTES), -(-(size["pairs"] or 0) // HUB_PAIRS))
    reached = (first.join(outs, "b").select("a", "chunk", "bits", "octets").repartition(tasks, "a", "chunk")
               .groupBy("a", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"), F.max("octets").alias("octets"))
               .select("a", "chunk", F.substring("bits", F.lit(1), F.col("octets")).alias("bits")))
    number = lambda at: F.conv(F.hex(F.substring("bits", at + 1, F.lit(1))), 16, 10).cast("int")
    octets = F.transform(F.sequence(F.lit(0), F.octet_length("bits") - 1), number)
    bits_of = lambda v, i: F.filter(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.when(F.getbit(v, k) == 1, i * 8 + k)),
                                    lambda p: p.isNotNull())
    set_bits = F.flatten(F.transform(octets, lambda v, i: F.when(v > 0, bits_of(v, i)).otherwise(F.array().cast("array<int>"))))
    found = reached.join(names, "chunk").select("a", F.explode(F.transform(set_bits, lambda p: F.element_at("cs", p + 1))).alias("c"))
    return found.where(F.col("c") != F.col("a"))


LIST_BLOCK = 256        # neighbours in one block of a list, at most


def neighbour_blocks(edges: DataFrame, src: str = "src", dst: str = "dst", block: int = LIST_BLOCK) -> DataFrame:
    """Neighbour lists in sorted blocks: node, blk, ids (ascending) and, in step with them, how often each is in the list.

    A block holds the neighbours of one range of ``block`` ids, so no array is
    longer, however many neighbours a node has; blocks of two nodes with the
    same ``blk`` cover the same ids.
    """
    counted = edges.groupBy(F.col(src).alias("node"), F.col(dst).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    listed = (counted.groupBy("node", F.floor(F.col("id") / block).cast("long").alias("blk"))
              .agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("l")))
    return listed.select("node", "blk", F.col("l.id").alias("ids"), F.col("l.n").alias("ns"))


def common_neighbours(edges: DataFrame, src: str = "src", dst: str = "dst", block: int = LIST_BLOCK) -> DataFrame:
    """``(src, dst, common)`` for each distinct edge of integer ids: how many items of src's neighbour list, repeats
    included, are in dst's (E15, H2).

    Lists meet block by block. An edge is driven by the end with fewer
    neighbours, so a hub's blocks are looked up by the others' and its own list
    is never gone through for each of its edges. Edges with a null end have no
    lists and give no row. Runs a job.
    """
    known = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("u"), F.col(dst).alias("v"))
    blocks = write_scratch(neighbour_blocks(known, "u", "v", block), "neighbour-blocks")
    size = blocks.groupBy("node").agg(F.sum(F.size("ids")).alias("size"))
    pairs = known.distinct()
    sized = (pairs.join(size.select(F.col("node").alias("u"), F.col("size").alias("nu")), "u")
             .join(size.select(F.col("node").alias("v"), F.col("size").alias("nv")), "v"))       # a dst without a list has nothing in common
    driven = sized.withColumn("by_u", F.col("nu") <= F.col("nv")).select(
        "u", "v", "by_u", F.when(F.col("by_u"), F.col("u")).otherwise(F.col("v")).alias("node"),
        F.when(F.col("by_u"), F.col("v")).otherwise(F.col("u")).alias("other"))
    met = (driven.join(blocks.withColumnsRenamed({"ids": "ids1", "ns": "ns1"}), "node")
           .join(blocks.select(F.col("node").alias("other"), "blk", F.col("ids").alias("ids2"), F.col("ns").alias("ns2")), ["other", "blk"]))
    left = F.map_from_arrays(F.when(F.col("by_u"), F.col("ids1")).otherwise(F.col("ids2")),
                             F.when(F.col("by_u"), F.col("ns1")).otherwise(F.col("ns2")))
    shared = F.aggregate(F.array_intersect("ids1", "ids2"), F.lit(0).cast("long"), lambda n, x: n + F.element_at("left", x))
    found = met.withColumn("left", left).groupBy("u", "v").agg(F.sum(shared).alias("common"))
    return pairs.join(found, ["u", "v"], "left").select(F.col("u").alias(src), F.col("v").alias(dst), F.coalesce("common", F.lit(0)).alias("common"))


def degree_oriented_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Canonical edges directed from the lower to the higher (degree, id) endpoint.

    Every node then has at most sqrt(2m) out-edges, which bounds the wedge join
    below by m * sqrt(2m) rows however skewed the degrees are.
    """
    ce = canonical_edges(edges, src, dst)
    ends = ce.select(F.explode(F.array("lo", "hi")).alias("v"))
    deg = ends.groupBy("v").agg(F.count(F.lit(1)).alias("deg"))
    d_lo = deg.select(F.col("v").alias("lo"), F.col("deg").alias("dlo"))
    d_hi = deg.select(F.col("v").alias("hi"), F.col("deg").alias("dhi"))
    j = ce.join(d_lo, "lo").join(d_hi, "hi")
    lo_first = F.struct("dlo", "lo") < F.struct("dhi", "hi")
    return j.select(F.when(lo_first, F.col("lo")).otherwise(F.col("hi")).alias("u"),
                    F.when(lo_first, F.col("hi")).otherwise(F.col("lo")).alias("v"))


def triangle_count(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Number of triangles of the undirected simple graph; each found exactly once."""
    o = degree_oriented_edges(edges, src, dst)
    ab = o.select(F.col("u").alias("a"), F.col("v").alias("b"))
    bc = o.select(F.col("u").alias("b"), F.col("v").alias("c"))
    ac = o.select(F.col("u").alias("a"), F.col("v").alias("c"))
    wedges = ab.join(bc, "b")
    closed = wedges.join(ac, ["a", "c"], "left_semi")
    return closed.agg(F.count(F.lit(1)).alias("triangles"))


def triangle_count_by_id(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Cross-check plan: id order instead of degree order (no wedge bound)."""
    ce = canonical_edges(edges, src, dst)
    e1 = ce.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    e2 = ce.select(F.col("lo").alias("b"), F.col("hi").alias("c"))
    e3 = ce.select(F.col("lo").alias("a"), F.col("hi").alias("c"))
    return (e1.join(e2, "b").join(e3, ["a", "c"], "left_semi")
            .agg(F.count(F.lit(1)).alias("triangles")))
