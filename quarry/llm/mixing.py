"""Mixing sources to target weights by Pfair scheduling.

Weights are whole numbers of slots; together they make a period of T slots. The
k-th block (from 0) of a source of n slots is released at slot floor(k * T / n)
and due by slot ceil((k + 1) * T / n); earliest deadline first over the released
blocks keeps every source within one block of n / T * time, in every period. So
the schedule repeats after T slots, only one period (a bounded table) is worked
out, and every block's slot follows from it. ``quantised`` makes whole weights
of any others: each within half a slot of its share, none without a slot.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.numbering import number_within
from quarry.llm.tables import cut
from quarry.operators.ordering import global_rank

LEAST_UNITS = 1000      # slots that shares are rounded to
UNITS_A_SOURCE = 64     # and for each source, so that many sources keep their shares
MAX_SOURCES = 1 << 16
MAX_PERIOD = MAX_SOURCES * UNITS_A_SOURCE * 2       # slots of the schedule table: the documented bound


def quantised(weights: Mapping[object, float], units: int | None = None) -> dict[object, int]:
    """Whole weights: the share of ``units`` slots, to the nearest slot, one at least for each positive weight."""
    live = {s: float(w) for s, w in weights.items() if w > 0}
    units = units or max(LEAST_UNITS, UNITS_A_SOURCE * len(live))
    total = math.fsum(live.values())
    return {s: max(1, math.floor(w / total * units + 0.5)) for s, w in live.items()}


def one_period(slots: Mapping[object, int]) -> list[tuple[object, int, int, int, int]]:
    """``(source, k, release, deadline, slot)`` for each block of one period, by earliest deadline first.

    Ties go to the source with more slots, then by the source's name.
    """
    period = sum(slots.values())
    names = sorted(slots, key=str)
    order = [(0, i, 0) for i in range(len(names))]           # (release, source, k) of each source's next block
    ready: list[tuple[int, int, int, int, int]] = []
    out = []
    for slot in range(period):
        while order and order[0][0] <= slot:
            release, i, k = heapq.heappop(order)
            n = slots[names[i]]
            heapq.heappush(ready, (-(-(k + 1) * period // n), -n, i, k, release))
        # total weight 1 keeps a released block at hand in every slot
        deadline, _, i, k, release = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a deadline was missed")
        n = slots[names[i]]
        out.append((names[i], k, release, deadline, slot))
        if k + 1 < n:
            heapq.heappush(order, ((k + 1) * period // n, i, k + 1))
    return out


def target_weights(docs: DataFrame, source_col: str = "source", exponent: float = 0.5) -> dict[object, int]:
    """Whole weights proportional to ``rows ** exponent``: a flattened mix, counted over all rows.

    One row per source reaches the driver; more than ``MAX_SOURCES`` are an error.
    """
    rows = docs.groupBy(F.col(source_col).alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return quantised({r["s"]: float(r["n"]) ** exponent for r in rows})


def mix_plan(docs: DataFrame, weights: Mapping[object, int], block_rows: int = 16,
             id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per input row: id, source, block, in_block, release, deadline, slot, position.

    Rows of a source are numbered in a stable pseudo-random order (by digest of
    the id) and cut into blocks of ``block_rows``. ``release``, ``deadline``
    and ``slot`` are the block's in the schedule of all sources. Slots of a
    source that has run out stay unused, which leaves the other sources'
    proportions as they are; ``position`` (from 0, without gaps) is the block's
    place among the blocks there are, so (position, in_block) is the mixed
    order, with every row in it once. Until a source runs out, its blocks among
    the first t slots differ from its weight's share of t by less than one,
    however many sources there are.

    Weights that are not whole, or a source without a positive one, are errors
    (no row may vanish). A null source is a source like any other, null ids are
    ids like any other, repeated rows get a place each, an empty table gives no
    rows, other columns are not read.
    """
    spark = docs.sparkSession
    if any(w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers of slots; quantised() makes them")
    slots = {s: int(w) for s, w in weights.items() if w > 0}
    total = sum(slots.values())
    if total > MAX_PERIOD:
        raise ValueError(f"weights add up to more than {MAX_PERIOD} slots")
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("src"))
    src = keyed.schema["src"].dataType.simpleString()
    names = sorted(slots, key=str)
    place = {s: i for i, s in enumerate(names)}
    per_source = spark.createDataFrame([(s, place[s], slots[s]) for s in names], f"n_src {src}, i bigint, n bigint")
    numbered = cut(number_within(keyed, "src", ["id"], "row")
                   .join(F.broadcast(per_source), F.col("src").eqNullSafe(F.col("n_src")), "left")      # a row for each of the bounded sources
                   .select("id", "src", "i", "n", F.expr(f"row div {int(block_rows)}").alias("block"),
                           (F.col("row") % int(block_rows)).alias("in_block")), "mix-rows")
    missing = [r["src"] for r in numbered.where("i is null").select("src").distinct().limit(5).collect()]
    if missing:
        raise ValueError(f"sources without a positive weight: {missing}")
    period = list(one_period(slots))
    table = spark.createDataFrame(pa.table(
        {"i": pa.array([place[s] for s, *_ in period], pa.int64()),
         **{c: pa.array([x[at] for x in period], pa.int64()) for at, c in enumerate(("k", "p_release", "p_deadline", "p_slot"), 1)}}))
    cycle = F.expr("block div n") * total
    blocks = (numbered.where("in_block = 0").select("i", "n", "block", (F.col("block") % F.col("n")).alias("k")).join(table, ["i", "k"])
              .select("i", "block", *[(cycle + F.col(f"p_{c}")).alias(c) for c in ("release", "deadline", "slot")]))
    blocks = global_rank(blocks, ["slot"], "rank")
    return (numbered.join(blocks, ["i", "block"])
            .select(F.col("id").alias(id_col), F.col("src").alias(source_col), "block", "in_block", "release", "deadline", "slot",
                    (F.col("rank") - 1).alias("position")))


def with_place(docs: DataFrame, weights: Mapping[object, int], block_rows: int = 16,
               id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``position`` and ``in_block`` of ``mix_plan``; columns of these names are replaced.

    Rows that share id and source have the first of their places.
    """
    places = (mix_plan(docs, weights, block_rows, id_col, source_col)
              .groupBy(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("src"))
              .agg(F.min(F.struct("position", "in_block")).alias("at")))
    places = cut(places, "mix-places")
    # the document's columns travel in one of their own, so none of their names meets another
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(f"`{id_col}`").alias("d_id"), F.col(f"`{source_col}`").alias("d_src"))
    joined = rows.join(places, F.col("d_id").eqNullSafe(F.col("id")) & F.col("d_src").eqNullSafe(F.col("src")))
    names = ("position", "in_block")
    return joined.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in names],
                         *[F.col("at").getField(c).alias(c) for c in names])


def mixed(docs: DataFrame, weights: Mapping[object, int], block_rows: int = 16,
          id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` in the mixed order of ``mix_plan``: same rows and columns, sorted by (position, in_block).

    Written out, the files in name order hold the mix. Rows that share id and
    source take any one of their places.
    """
    placed = with_place(docs, weights, block_rows, id_col, source_col)
    kept = [c for c in docs.columns if c not in ("position", "in_block")]
    if len(kept) == len(docs.columns):
        return placed.orderBy("position", "in_block").select(*[F.col(f"`{c}`") for c in docs.columns])
    # columns of those names are the documents' own: the place leaves, they come back
    return mixed(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]), weights, block_rows,
                 f"c{docs.columns.index(id_col)}", f"c{docs.columns.index(source_col)}").toDF(*docs.columns)
