"""Row ordinals, running totals, total-order ranks and range layouts
(inventory F1, F3, G1-G8, B8).

No function here uses a window without PARTITION BY on the full data. Two exact
schemes replace it:

* integer keys (``bucketed_*``): rows are grouped in buckets of neighbouring keys,
  per-bucket totals (one row per bucket) get their exclusive prefix, which is
  joined back. Where the buckets begin follows from the keys themselves: a
  mergeable quantile sketch of them, made by partial aggregation, gives cut
  points of equal shares of the rows, and a long share is divided evenly
  between its cut points (``key_buckets``). So buckets hold about as many rows
  whether keys are dense, sparse over 64 bits or clustered in narrow bands, and
  their prefix takes one level. Repeats of one key share its bucket. Null keys
  come first, in a bucket of their own; a null group is a group.
* arbitrary sort keys (``global_rank``): a sampled range exchange sorts the data,
  the sorted rows are written once, with their partition id and position, to a
  table in the shared checkpoint folder (so the sampled split points are
  computed exactly once), then per-partition counts give each partition its
  offset.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import static_range_bucket
from quarry.session import scratch_path

AUTO = "auto"                    # bucket_width: buckets by a quantile sketch of the keys
TARGET_ROWS = 1 << 16            # rows of a bucket aimed at
SHARES = 256                     # equal shares that the sketch cuts the rows into, at most
SKETCH_K = 4096                  # its size: ranks to about 0.13 % of the rows, a third of a share
TOP_FAN_OUT = 1 << 16            # buckets per super-bucket in the cross-bucket prefix
NULL_BUCKET = -(1 << 62)


def _floor_div(col: Column, width: int) -> Column:
    w = F.lit(width)
    return ((col - F.pmod(col, w)) / w).cast("long")


def _decide(key: Column, cuts: list[int], leaf: Callable[[int], Column], lo: int = 0, hi: int | None = None) -> Column:
    """``leaf(i)`` of the share i that the key lies in (shares begin at the cuts), found by halving."""
    hi = len(cuts) if hi is None else hi
    if lo == hi:
        return leaf(lo)
    mid = (lo + hi) // 2
    return F.when(key < F.lit(cuts[mid]), _decide(key, cuts, leaf, lo, mid)).otherwise(_decide(key, cuts, leaf, mid + 1, hi))


def key_buckets(df: DataFrame, order_key: str, bucket_width: int | str = AUTO, key_bits: int = 64,
                target_rows: int | None = None) -> tuple[Column, int]:
    """The bucket (a long that rises with the key) of each row, and the levels that the buckets' prefix takes.

    ``AUTO`` runs one job over the key column, whose result is the sketch's
    quantiles (``SHARES`` numbers) and the count. A number for ``bucket_width``
    cuts at its multiples instead, for dense keys of at most ``key_bits`` bits.
    The prefix's last step then sees ``TOP_FAN_OUT`` rows at most.
    """
    key = F.col(order_key).cast("long")
    if bucket_width != AUTO:
        return F.coalesce(_floor_div(key, int(bucket_width)), F.lit(NULL_BUCKET)), _levels(key_bits - int(bucket_width).bit_length() + 1)
    ranks = F.array(*[F.lit(i / SHARES) for i in range(SHARES + 1)])
    found = (df.agg(F.count(order_key).alias("n"), F.kll_sketch_agg_bigint(key, SKETCH_K).alias("s"))
             .select("n", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("s", ranks)).alias("q")).first())
    n, at = found["n"], found["q"]
    if not n:
        return F.when(key.isNull(), F.lit(NULL_BUCKET)).otherwise(F.lit(0).cast("long")), 0
    buckets = max(1, -(-n // (target_rows or TARGET_ROWS)))
    shares = min(SHARES, buckets)
    inner = -(-buckets // shares)
    cuts = sorted({at[i * SHARES // shares] for i in range(1, shares)})
    ends = [at[0], *cuts, at[-1] + 1]

    def leaf(i: int) -> Column:
        first, span = ends[i], max(1, ends[i + 1] - ends[i])
        if inner == 1:
            return F.lit(i).cast("long")
        # keys beyond the sketch's ends stay in the first and last bucket
        part = F.floor((key.cast("decimal(20,0)") - F.lit(first)) * inner / F.lit(span))
        return (F.lit(i * inner) + F.greatest(F.lit(0), F.least(F.lit(inner - 1), part))).cast("long")

    bucket = F.when(key.isNull(), F.lit(NULL_BUCKET)).otherwise(_decide(key, cuts, leaf))
    return bucket, _levels((shares * inner).bit_length())


def _join_back(local: DataFrame, per_bucket: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``local`` with the other columns of ``per_bucket``, by ``keys`` that may be null."""
    named = per_bucket.select(*[F.col(f"`{k}`").alias(f"_qk{i}") for i, k in enumerate(keys)],
                              *[c for c in per_bucket.columns if c not in keys])
    on = [local[f"`{k}`"].eqNullSafe(named[f"_qk{i}"]) for i, k in enumerate(keys)]
    return local.join(named, reduce(and_, on)).drop(*[f"_qk{i}" for i in range(len(keys))])


def _levels(bits: int) -> int:
    """Super-bucket levels over 2^bits buckets that leave at most TOP_FAN_OUT rows (and the null bucket's) for the last step."""
    fan = TOP_FAN_OUT.bit_length() - 1
    return max(0, -(-(bits - fan) // fan))


def _bucket_prefix(per_bucket: DataFrame, bucket: str, total: str, out: str,
                   combine: str = "sum", levels: int = 1) -> DataFrame:
    """Exclusive running total (``combine="sum"``) or running max over one row
    per bucket, level by level: within super-buckets of TOP_FAN_OUT buckets,
    then the same over one row per super-bucket, and after ``levels`` levels in
    one window. See ``_levels``: that window sees at most TOP_FAN_OUT rows.
    """
    agg = F.sum if combine == "sum" else F.max
    if levels == 0:
        before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        return per_bucket.select(bucket, agg(total).over(before).alias(out))
    sb = f"_qsb{levels}"
    t = per_bucket.select(bucket, total, _floor_div(F.col(bucket), TOP_FAN_OUT).alias(sb))
    before = Window.partitionBy(sb).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    local = t.select(bucket, sb, agg(total).over(before).alias("_lo"))
    sup = t.groupBy(sb).agg(agg(total).alias("_st"))
    sup_off = _bucket_prefix(sup, sb, "_st", "_so", combine, levels - 1)
    if combine == "sum":
        value = F.coalesce(F.col("_so"), F.lit(0)) + F.coalesce(F.col("_lo"), F.lit(0))
    else:
        value = F.greatest("_so", "_lo")
    return local.join(sup_off, sb).select(bucket, value.alias(out))


def _bucket_lead(firsts: DataFrame, bucket: str, value: str, out: str, levels: int) -> DataFrame:
    """``value`` of the next bucket there is, over one row per bucket, level by level as ``_bucket_prefix``."""
    if levels == 0:
        return firsts.select(bucket, F.lead(value).over(Window.orderBy(bucket)).alias(out))
    sb = f"_qsb{levels}"
    t = firsts.select(bucket, value, _floor_div(F.col(bucket), TOP_FAN_OUT).alias(sb))
    local = t.select(bucket, sb, F.lead(value).over(Window.partitionBy(sb).orderBy(bucket)).alias("_ln"))
    sup = t.groupBy(sb).agg(F.min_by(value, bucket).alias("_sf"))
    above = _bucket_lead(sup, sb, "_sf", "_sn", levels - 1)
    return local.join(above, sb).select(bucket, F.coalesce("_ln", "_sn").alias(out))


def bucketed_running_sum(df: DataFrame, order_key: str, value: Column | str, out: str,
                         partition_by: Sequence[str] = (), inclusive: bool = True,
                         bucket_width: int | str = AUTO, tie_breakers: Sequence[str] = (), key_bits: int = 64) -> DataFrame:
    """Exact running total of ``value`` in ascending integer ``order_key`` order, null keys first.

    ``partition_by`` restarts the total per group; a hot group is still split
    into buckets, so no task receives a whole group. The rows are shuffled
    once: the per-bucket totals are taken from the same bucket-partitioned rows
    as the local running sums (the exchange is reused), and only those totals
    meet in the cross-bucket prefix.
    """
    v = F.col(value) if isinstance(value, str) else value
    parts = list(partition_by)
    b = "_qb"
    bucket, levels = key_buckets(df, order_key, bucket_width, key_bits)
    with_b = df.withColumn(b, bucket).withColumn("_qv", v)
    end = 0 if inclusive else -1
    local_w = (Window.partitionBy(*parts, b).orderBy(order_key, *tie_breakers)
               .rowsBetween(Window.unboundedPreceding, end))
    local = with_b.withColumn("_ql", F.coalesce(F.sum("_qv").over(local_w), F.lit(0)))
    per_bucket = local.groupBy(*parts, b).agg(F.sum("_qv").alias("_qt"))
    if parts:
        w = Window.partitionBy(*parts).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_bucket.select(*parts, b, F.coalesce(F.sum("_qt").over(w), F.lit(0)).alias("_qo"))
    else:
        offsets = _bucket_prefix(per_bucket, b, "_qt", "_qo", levels=levels)
    return (_join_back(local, offsets, [*parts, b])
            .withColumn(out, F.coalesce(F.col("_qo"), F.lit(0)) + F.col("_ql"))
            .drop(b, "_qv", "_qo", "_ql"))


def bucketed_running_max(df: DataFrame, order_key: str, value: str, out: str,
                         partition_by: Sequence[str] = (),
                         bucket_width: int | str = AUTO, key_bits: int = 64) -> DataFrame:
    """Running max of ``value`` (any orderable type) in ascending integer
    ``order_key`` order, restarted per ``partition_by`` group, with the same
    bucketing as ``bucketed_running_sum`` (a hot group is split over buckets)."""
    parts = list(partition_by)
    b = "_qb"
    bucket, levels = key_buckets(df, order_key, bucket_width, key_bits)
    with_b = df.withColumn(b, bucket)
    local_w = Window.partitionBy(*parts, b).orderBy(order_key).rowsBetween(Window.unboundedPreceding, 0)
    local = with_b.withColumn("_ql", F.max(value).over(local_w))
    per_bucket = local.groupBy(*parts, b).agg(F.max(value).alias("_qt"))
    if parts:
        prev = Window.partitionBy(*parts).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_bucket.select(*parts, b, F.max("_qt").over(prev).alias("_qo"))
    else:
        offsets = _bucket_prefix(per_bucket, b, "_qt", "_qo", "max", levels)
    return (_join_back(local, offsets, [*parts, b])
            .withColumn(out, F.greatest("_qo", "_ql"))
            .drop(b, "_qo", "_ql"))


def bucketed_lead(df: DataFrame, order_key: str, value: str, out: str, partition_by: Sequence[str] = (),
                  bucket_width: int | str = AUTO, key_bits: int = 64) -> DataFrame:
    """``value`` of the next row in ``order_key`` order within each
    ``partition_by`` group (a lead), null for the last row.

    One shuffle by (group, key bucket): a windowed lead inside the bucket; the
    last row of a bucket takes the value of the first row of the group's next
    non-empty bucket, looked up from one row per bucket. A very long group is
    spread over many tasks."""
    parts = list(partition_by)
    b = "_qb"
    bucket, levels = key_buckets(df, order_key, bucket_width, key_bits)
    with_b = df.withColumn(b, bucket)
    w = Window.partitionBy(*parts, b).orderBy(order_key)
    # lags, not row_number, mark a bucket's first and leads its last row (a null value is a value): the filter on
    # the first row then shares this window and its exchange instead of being planned apart
    one = F.lit(1)
    local = (with_b.withColumn("_qn", F.lead(value).over(w)).withColumn("_qr", F.lag(one).over(w))
             .withColumn("_qe", F.lead(one).over(w)))
    firsts = local.where(F.col("_qr").isNull()).select(*parts, b, F.col(value).alias("_qf"))
    if parts:
        nextb = firsts.select(*parts, b, F.lead("_qf").over(Window.partitionBy(*parts).orderBy(b)).alias("_qnb"))
    else:
        nextb = _bucket_lead(firsts, b, "_qf", "_qnb", levels)
    return (_join_back(local, nextb, [*parts, b])
            .withColumn(out, F.when(F.col("_qe").isNull(), F.col("_qnb")).otherwise(F.col("_qn")))
            .drop(b, "_qn", "_qr", "_qe", "_qnb"))


def bucketed_next(df: DataFrame, order_key: str, out: str, partition_by: Sequence[str] = (),
                  bucket_width: int | str = AUTO) -> DataFrame:
    """The next ``order_key`` value within each ``partition_by`` group."""
    return bucketed_lead(df, order_key, order_key, out, partition_by, bucket_width)


def bucketed_ordinal(df: DataFrame, order_key: str, out: str = "ordinal",
                     bucket_width: int | str = AUTO, start: int = 0,
                     tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Dense row number in ``order_key`` order (F1) starting at ``start``."""
    r = bucketed_running_sum(df, order_key, F.lit(1).cast("long"), "_qord", inclusive=False,
                             bucket_width=bucket_width, tie_breakers=tie_breakers)
    return r.withColumn(out, F.col("_qord") + F.lit(start)).drop("_qord")


def global_rank(df: DataFrame, order_cols: Sequence[Column | str], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """1-based rank of every row in a total order of ``order_cols``.

    ``order_cols`` must be a total order (add a unique tie key) for the rank to be
    deterministic. A sampled range exchange sorts the rows; each row's partition
    id and position are written with it, in one job, to a table in the shared
    checkpoint folder, so the split points are computed once and the lineage is
    cut. Per-partition counts over that table then give each partition its offset.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # Without an explicit count the range exchange starts from the session's
    # shuffle partitions and adaptive execution may merge neighbours; merged
    # partitions are contiguous ranges, so the order across partition ids holds.
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    path = scratch_path(spark, "rank")
    (ranged.sortWithinPartitions(*cols)
     .withColumn("_qp", F.spark_partition_id())
     .withColumn("_qm", F.monotonically_increasing_id())
     .write.parquet(path))
    sorted_df = spark.read.parquet(path)
    local = F.col("_qm") - F.shiftleft(F.col("_qp").cast("long"), 33)
    per_part = sorted_df.groupBy("_qp").agg(F.count(F.lit(1)).alias("_qn"))
    offsets = _bucket_prefix(per_part, "_qp", "_qn", "_qo")     # partition ids are dense: one level will do
    return (sorted_df.join(offsets, "_qp")
            .withColumn(out, F.col("_qo") + local + F.lit(1))
            .drop("_qp", "_qm", "_qo"))


def total_order_sort(df: DataFrame, key: str, tie_breakers: Sequence[str] = (),
                     out: str = "rank") -> DataFrame:
    """Rows in byte order of ``key`` with their global rank; duplicates kept."""
    return global_rank(df, [key, *tie_breakers], out=out)


def with_static_range(df: DataFrame, key: str, out: str = "bucket") -> DataFrame:
    return df.withColumn(out, static_range_bucket(F.col(key)))


def rank_within_static_range(df: DataFrame, key: str, tie_breakers: Sequence[str] = (),
                             out: str = "rank_in_bucket") -> DataFrame:
    """Bucket by first character (G4), then rank inside the bucket by key.

    The rank is a global rank over (bucket, key, ties) minus the bucket's first
    global rank, so ten buckets still sort in many parallel range partitions.
    """
    b = with_static_range(df, key, "bucket")
    ranked = global_rank(b, ["bucket", key, *tie_breakers], out="_qg")
    firsts = ranked.groupBy("bucket").agg(F.min("_qg").alias("_qf"))
    return (ranked.join(firsts, "bucket")
            .withColumn(out, F.col("_qg") - F.col("_qf") + F.lit(1))
            .drop("_qg", "_qf"))


def static_range_layout(df: DataFrame, key: str, exact_ten: bool = False) -> DataFrame:
    """Layout for a ten-range output (B8): sorted by key inside each range.

    ``exact_ten`` puts range b in partition b (one file per range, ten writers);
    otherwise each range is itself range-partitioned, so part files in name order
    are in key order and the write stays parallel.
    """
    b = with_static_range(df, key, "bucket")
    if exact_ten:
        return b.repartitionById(10, F.col("bucket")).sortWithinPartitions(key)
    return b.repartitionByRange("bucket", key).sortWithinPartitions("bucket", key)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                    k: int, out: str = "rank") -> DataFrame:
    """Top-k rows per group (F5/G7); Spark applies a per-partition group limit
    before the shuffle, so each group ships at most k rows per task."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(out, F.row_number().over(w).cast("long")).where(F.col(out) <= k)
