"""Fixed-size count windows over an explicit row ordinal, batch form
(inventory J4-J10, F3-F5, G6, G7).

A count window is ``ordinal div N``. Windows are built by ordinary grouping, so
they are computed in parallel; only complete windows (exactly N rows) are
emitted, as with a count trigger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import DataType, NumericType

from quarry.operators.ordering import AUTO, _join_back, bucketed_running_max, bucketed_running_sum, top_k_per_group
from quarry.session import write_scratch


DENSE_WIDTH = 1 << 16   # windows of a bucket in the running steps over windows
WINDOW_BITS = 48        # of a window id, which counts windows from 0


def window_id(ordinal: str | Column, n: int) -> Column:
    o = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return F.floor(o / F.lit(n)).cast("long")


def complete_windows(df: DataFrame, ordinal: str, n: int) -> DataFrame:
    """Ids of windows that hold exactly ``n`` rows (partial counts per task).

    For a dense ordinal 0..T-1 prefer ``is_complete(window_id, T, n)`` with T a
    scalar: it needs no second pass over the rows.
    """
    return (df.groupBy(window_id(ordinal, n).alias("window_id"))
            .agg(F.count(F.lit(1)).alias("_c"))
            .where(F.col("_c") == n).select("window_id"))


def is_complete(wid: Column, total_rows: Column, n: int) -> Column:
    """Window ``wid`` of a dense ordinal 0..total_rows-1 holds ``n`` rows."""
    return wid < F.floor(total_rows / F.lit(n))


def count_window_sum(df: DataFrame, ordinal: str, value: str, n: int, decimal: str = "decimal(18,2)") -> DataFrame:
    """Sum of ``value`` per complete window, returned as double. Values are summed
    exactly in ``decimal``, rounded to its scale."""
    return (df.groupBy(window_id(ordinal, n).alias("window_id"))
            .agg(F.sum(F.col(value).cast(decimal)).alias("_s"), F.count(F.lit(1)).alias("_c"))
            .where(F.col("_c") == n)
            .select("window_id", F.col("_s").cast("double").alias("total")))


def count_window_running_sum(df: DataFrame, ordinal: str, value: str, n: int,
                             bucket_width: int | str = AUTO, decimal: str = "decimal(18,2)") -> DataFrame:
    """Running total emitted at the end of every complete window (values in ``decimal``, as above).

    Per-window sums are small (rows / n); the running total over them is the
    bucketed prefix sum, so even a very long stream never meets one task.
    """
    per_window = (df.groupBy(window_id(ordinal, n).alias("window_id"))
                  .agg(F.sum(F.col(value).cast(decimal)).alias("_s"),
                       F.count(F.lit(1)).alias("_c"))
                  .where(F.col("_c") == n))
    width = DENSE_WIDTH if bucket_width == AUTO else bucket_width       # window ids are dense
    run = bucketed_running_sum(per_window, "window_id", "_s", "_r", bucket_width=width, key_bits=WINDOW_BITS)
    return run.select("window_id", F.col("_r").cast("double").alias("running_total"))


def count_window_top_k(items: DataFrame, windows_ok: DataFrame | Column, item: str, k: int) -> DataFrame:
    """Top-k items by count inside each complete window (ties by item).

    ``items`` has ``window_id`` and ``item``; ``windows_ok`` lists complete
    windows, or is a boolean column over ``window_id`` (see ``is_complete``).
    """
    if isinstance(windows_ok, DataFrame):
        kept = items.join(windows_ok, "window_id", "left_semi")
    else:
        kept = items.where(windows_ok)
    # items partitioned by window are counted and ranked where they are; others
    # are counted partially per task before the exchange, and the ranking then
    # ships at most k rows per window and task
    counts = kept.groupBy("window_id", item).agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, ["window_id"], [F.desc("n"), F.col(item)], k)


def _group_partials(df: DataFrame, ordinal: str, group: str, item: str, value: str, n: int) -> DataFrame:
    tie = F.struct(F.col(value).alias("v"), (-F.col(ordinal)).alias("o"), F.col(item).alias("i"))
    return (df.groupBy(window_id(ordinal, n).alias("window_id"), F.col(group))
            .agg(F.count(F.lit(1)).alias("n"), F.max(tie).alias("best")))


def _keep_complete(parts: DataFrame, df: DataFrame, ordinal: str, n: int,
                   total_rows: Column | None) -> DataFrame:
    if total_rows is not None:
        return parts.where(is_complete(F.col("window_id"), total_rows, n))
    return parts.join(complete_windows(df, ordinal, n), "window_id", "left_semi")


def count_window_group_top(df: DataFrame, ordinal: str, group: str, item: str, value: str,
                           n: int, k: int, total_rows: Column | None = None) -> DataFrame:
    """Per complete window: per group count, max value and its item (earliest row
    wins a tie); the k groups with most rows (ties by group).

    ``total_rows`` (a scalar column) marks the ordinal as dense 0..T-1, which
    lets completeness be decided without another pass over ``df``."""
    parts = _group_partials(df, ordinal, group, item, value, n)
    parts = _keep_complete(parts, df, ordinal, n, total_rows)
    top = top_k_per_group(parts, ["window_id"], [F.desc("n"), F.col(group)], k)
    return top.select("window_id", "rank", group, "n",
                      F.col("best.v").alias("max_value"), F.col("best.i").alias("top_item"))


def cumulative_group_top(df: DataFrame, ordinal: str, group: str, item: str, value: str,
                         n: int, k: int, total_rows: Column | None = None) -> DataFrame:
    """After every complete window: per group count, max and argmax over all rows
    so far, and the k groups with most rows so far (ties by group). Runs a job
    (see ``cumulative_top``)."""
    parts = _group_partials(df, ordinal, group, item, value, n)
    if total_rows is not None:
        last = F.floor(total_rows / F.lit(n)) - 1
    else:
        last = complete_windows(df, ordinal, n).agg(F.max("window_id")).scalar()  # scalar subquery
    return cumulative_top(parts, group, k, last)


def _group_cumulative(parts: DataFrame, group: str, last: Column, bucket_width: int) -> DataFrame:
    """Per (window, group) partial: the group's count and best row so far, and
    its next update window (``last + 1`` if none).

    One bucketed pass (the fused form of ``bucketed_running_sum``,
    ``bucketed_running_max`` and ``bucketed_next``): rows are shuffled once by
    (group, window bucket) for the local running sum, running max and lead;
    one row per (group, bucket) carries the earlier buckets' totals and the next
    bucket's first window. A group present in every window is spread over many
    tasks."""
    b = "_qb"
    sparse = parts.where(F.col("window_id") <= last).withColumn(
        b, F.floor(F.col("window_id") / F.lit(bucket_width)).cast("long"))
    w_local = Window.partitionBy(group, b).orderBy("window_id")
    upto = w_local.rowsBetween(Window.unboundedPreceding, 0)
    local = sparse.select("window_id", group, b, "n", "best",
                          F.sum("n").over(upto).alias("_ln"),
                          F.max("best").over(upto).alias("_lb"),
                          F.lead("window_id").over(w_local).alias("_lx"))
    per_bucket = local.groupBy(group, b).agg(F.sum("n").alias("_bn"), F.max("best").alias("_bb"),
                                             F.min("window_id").alias("_bf"))
    w_buckets = Window.partitionBy(group).orderBy(b)
    before = w_buckets.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(group, b,
                              F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_cn"),
                              F.max("_bb").over(before).alias("_cb"),
                              F.lead("_bf").over(w_buckets).alias("_cx"))
    return (_join_back(local, carry, [group, b])
            .select("window_id", group, (F.col("_cn") + F.col("_ln")).alias("cn"),
                    F.greatest("_cb", "_lb").alias("best"),
                    F.coalesce("_lx", "_cx", last + 1).alias("_next")))


def _descending(group: str, kind: DataType) -> Column:
    """A value that falls as the group's value rises."""
    if isinstance(kind, NumericType):
        return -F.col(group)
    # hex digits turned round; the end mark is above them, so a prefix comes after what it starts
    hexed = F.hex(F.encode(F.col(group).cast("string"), "UTF-8"))
    return F.concat(F.translate(hexed, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))


def cumulative_pieces(parts: DataFrame, group: str, k: int, last: Column, bucket_width: int = 1 << 12,
                      cut_rows: int = 4) -> DataFrame:
    """The stretches of windows ``[s, e)`` in which a group's state can be among the top k.

    A state holds from an update to the group's next one. It is cut at every
    L-th window, L so chosen that the cuts add at most ``cut_rows`` rows per
    partial. Keys ``(count so far, group descending)`` only grow, so the k-th
    best key T(w) never falls. Every group with a state has a piece that starts
    at a cut, so the k-th best key there is T itself; at other windows the k-th
    best of the groups just updated is a lower bound. The running max of both
    bounds T from below at every window, and a piece can matter only if its key
    reaches the bound at its start. The partials are computed once, in a job
    that writes the states (``write_scratch``).
    """
    states = write_scratch(_group_cumulative(parts, group, last, bucket_width), "cumulative")
    size = states.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(group).alias("groups"),
                      F.max("_next").alias("windows")).first()
    cuts = max(1, cut_rows * size["rows"] // max(1, size["groups"]))
    step = max(1, -(-(size["windows"] or 1) // cuts))
    after = F.expr(f"(window_id div {step} + 1) * {step}")
    starts = F.concat(F.array("window_id"), F.when(after < F.col("_next"), F.sequence(after, F.col("_next") - 1, F.lit(step).cast("long")))
                      .otherwise(F.array().cast("array<bigint>")))
    pieces = (states.select(F.explode(starts).alias("s"), "_next", group, "cn", "best")
              .withColumn("e", F.least("_next", F.expr(f"(s div {step} + 1) * {step}")))
              .withColumn("_key", F.struct(F.col("cn").alias("c"), F.col(group).isNull().alias("z"),      # a null group is first
                                           _descending(group, states.schema[group].dataType).alias("g"))))
    leading = top_k_per_group(pieces.select("s", "_key"), ["s"], [F.desc("_key")], k)
    kth = leading.groupBy("s").agg(F.max(F.when(F.col("rank") == k, F.col("_key"))).alias("_kth"))
    bits = int(size["windows"] or 1).bit_length()
    bound = bucketed_running_max(kth, "s", "_kth", "_bound", bucket_width=bucket_width, key_bits=bits).select("s", "_bound")
    return (pieces.join(bound, "s").where(F.col("_bound").isNull() | (F.col("_key") >= F.col("_bound")))
            .select("s", "e", group, F.col("cn").alias("n"), "best"))


def cumulative_top(parts: DataFrame, group: str, k: int, last: Column, bucket_width: int = 1 << 12) -> DataFrame:
    """Exact cumulative top-k after every window, from per-(window, group) partials ``n`` and ``best``
    (struct of value ``v``, negated ordinal ``o``, item ``i``) up to window ``last``.

    Only the pieces that can reach the top k become one row per window, for any
    orderable group key; there is no dense group x window grid.
    """
    pieces = cumulative_pieces(parts, group, k, last, bucket_width)
    grid = pieces.select(F.explode(F.sequence("s", F.col("e") - 1)).alias("window_id"), group, "n", "best")
    top = top_k_per_group(grid, ["window_id"], [F.desc("n"), F.col(group)], k)
    return top.select("window_id", "rank", group, "n",
                      F.col("best.v").alias("max_value"), F.col("best.i").alias("top_item"))
