"""Gapless numbers within groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.tables import cut

CHUNK = 4096            # identical rows are numbered in runs of at most this many
BUCKET_HEX_DIGITS = 3   # 4096 buckets a group


def text_key(*cols: Column) -> Column:
    """A stable text of the values; null has its own mark."""
    parts = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]
    return F.concat_ws("|", *parts)


def number_within(df: DataFrame, group: str, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each ``group``, in a stable pseudo-random order.

    ``df`` has to be narrow (keys and digests, no texts). Rows equal in all
    columns are first counted (map-side combine), so no copy count makes a hot
    key; a group is then cut into 4096 hash buckets, each bucket is numbered by
    a window of its own, and the buckets' first numbers come from a running sum
    over at most 4096 rows a group. Runs one job (the counted rows are written
    once). Null groups and keys are values like any other; an empty input gives
    an empty result.
    """
    cols = df.columns
    n, chunk, bucket, base, run = "__n", "__chunk", "__bucket", "__base", "__run"
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
    runs = (counted
            .withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"),
                                                    F.expr(f"cast(({n} - 1) div {CHUNK} as bigint)"))))
            .withColumn(run, F.least(F.lit(CHUNK).cast("long"), F.col(n) - F.col(chunk) * CHUNK))
            .withColumn(bucket, F.substring(F.md5(text_key(*[F.col(k) for k in keys], F.col(chunk))),
                                            1, BUCKET_HEX_DIGITS))
            .drop(n))
    runs = cut(runs, "numbering")
    by_bucket = W.partitionBy(group).orderBy(bucket)
    # the group's columns get names of their own on this side of the join
    bases = (runs.groupBy(group, bucket).agg(F.sum(run).alias(base))
             .withColumn(base, F.sum(base).over(by_bucket) - F.col(base))
             .select(F.col(group).alias("__g"), F.col(bucket).alias("__b"), base))
    inside = W.partitionBy(group, bucket).orderBy(*keys, chunk).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = runs.withColumn("__first", F.sum(run).over(inside) - F.col(run))
    joined = numbered.join(bases, F.col(group).eqNullSafe(F.col("__g")) & (F.col(bucket) == F.col("__b")))
    return (joined
            .withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col(run) - 1)))
            .withColumn(name, F.col("__base") + F.col("__first") + F.col(name))
            .select(*cols, name))
