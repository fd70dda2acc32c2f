"""Filters, joins and grouped aggregates (inventory C1-C12, D1, E5-E10, E17, H1, I11, B7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from quarry.functions.scalars import address_prefix, report_line


def skip_first_rows(df: DataFrame, order_col: str, n: int = 1) -> DataFrame:
    """Drop the ``n`` first rows in ``order_col`` order (a header skip by rank);
    ``order_col`` must be unique, as a rank key is.

    Only the ``n`` smallest keys are found (a bounded top-n, ``n`` rows per task)
    and removed with an anti join whose build side is exactly ``n`` rows.
    """
    head = df.select(F.col(order_col).alias("_qh")).orderBy("_qh").limit(n)      # a null key is the smallest
    return df.join(F.broadcast(head), F.col(order_col).eqNullSafe(F.col("_qh")), "left_anti")


def grouped_sum_having(df: DataFrame, key: str, value: str, threshold: float,
                       out: str = "total", decimal: str | None = "decimal(18,2)") -> DataFrame:
    """SUM per key, keep groups above ``threshold``, largest first.

    ``decimal`` names the exact type to sum a fractional value in (values are
    rounded to its scale; the total is returned as a double). With ``None`` the
    value is summed as it is and the sum keeps its type: integral sums stay long.
    """
    v = F.col(value).cast(decimal) if decimal else F.col(value)
    agg = df.groupBy(key).agg(F.sum(v).alias("_s"))
    total = F.col("_s").cast("double") if decimal else F.col("_s")
    return (agg.where(F.col("_s") > F.lit(threshold))
            .select(key, total.alias(out))
            .orderBy(F.desc(out), key))


def distinct_pairs_per_source(df: DataFrame, source: str, dest: str, out: str = "n",
                              approx_rsd: float | None = None) -> DataFrame:
    """Number of distinct (source, dest) pairs per source, most first.

    Two aggregations: the distinct step shuffles on (source, dest), which spreads
    a hot source over many tasks; the count step then ships one partial count per
    source and task. A null source group counts 0, like a first-field COUNT.
    ``approx_rsd`` opts into one HyperLogLog++ aggregate per source (relative
    standard deviation ``approx_rsd``; null destinations are not counted).
    """
    if approx_rsd is not None:
        return (df.groupBy(source).agg(F.approx_count_distinct(dest, approx_rsd).alias(out))
                .orderBy(F.desc(out), source))
    pairs = df.select(source, dest).distinct()
    return (pairs.groupBy(source).agg(F.count(source).alias(out))
            .orderBy(F.desc(out), source))


def filtered_join_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                        right_filter: Column, group_col: str, out: str = "n") -> DataFrame:
    """Inner equi-join of ``left`` to the filtered ``right``, then count per ``group_col``.

    The filter and the projection reach the right scan; the join strategy
    (broadcast when the filtered side measures small, else sort-merge with skew
    splitting) is chosen by adaptive execution from runtime sizes.
    """
    r = right.where(right_filter).select(F.col(right_key).alias("_rk"))
    l = left.select(F.col(left_key).alias("_rk"), group_col)
    joined = l.join(r, "_rk")
    return joined.groupBy(group_col).agg(F.count(F.lit(1)).alias(out))


def count_max_argmax(df: DataFrame, group_col: str, item_col: str, value_col: str,
                     order_col: str) -> DataFrame:
    """Per group: row count, max value, and the item of the max value.

    On a tie the earliest row (smallest ``order_col``) wins. Every aggregate is
    partial-capable, so a hot group costs one partial row per task.
    """
    tie = F.struct(F.col(value_col), (-F.col(order_col)).alias("_o"))
    return (df.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.max(value_col).alias("max_value"),
                 F.max_by(F.col(item_col), tie).alias("top_item")))


def fixed_width_report(stats: DataFrame, group_col: str) -> DataFrame:
    """One fixed-width text line per group of ``count_max_argmax`` output.
    Integral values print as integers, fractional ones with two decimals."""
    v = F.col("max_value")
    if not isinstance(stats.schema["max_value"].dataType, IntegralType):
        v = v.cast("decimal(18,2)")
    return stats.select(report_line(F.col(group_col), F.col("n"), F.col("top_item").cast("string"),
                                    v.cast("string")).alias("line"))


def extract_addresses(df: DataFrame, address: Column, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, address.alias("address"), address_prefix(address).alias("host"))
