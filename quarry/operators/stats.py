"""Group statistics attached to rows, 3-sigma labels, byte checksums
(inventory D2, E11, E18, F2, C7, C10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import fold_byte_lanes, xor_fold_words

LABEL_LOW, LABEL_HIGH, LABEL_FLAT = "low", "high", "flat"


def _label(price, mean, std, sigmas: float):
    return (F.when(price < mean - F.lit(sigmas) * std, F.lit(LABEL_LOW))
            .when(price > mean + F.lit(sigmas) * std, F.lit(LABEL_HIGH))
            .otherwise(F.lit(LABEL_FLAT)))


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, population mean and population standard deviation per key."""
    return df.groupBy(*keys).agg(F.count(value).alias("cnt"),
                                 F.avg(value).alias("mean"),
                                 F.stddev_pop(value).alias("std"))


def sigma_outliers(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = 3.0,
                   keep_flat: bool = False) -> DataFrame:
    """Label each row low/high/flat against its group's mean +- sigmas*std; drop flat.

    Statistics come from a partial-capable aggregate joined back on the keys: the
    stats side is one row per group, so it is broadcast when adaptive execution
    measures it small, and a hot group on the row side is split by the skew join
    instead of landing in one window task.
    """
    names = [f"_qk{i}" for i in range(len(keys))]
    stats = group_stats(df, keys, value).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("mean").alias("_qmean"),
                                                F.col("std").alias("_qstd"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]        # a null key is a group, as in the window form
    labelled = df.join(stats, reduce(and_, same)).withColumn(
        "label", _label(F.col(value), F.col("_qmean"), F.col("_qstd"), sigmas))
    if not keep_flat:
        labelled = labelled.where(F.col("label") != LABEL_FLAT)
    return labelled.drop(*names, "_qmean", "_qstd")


def sigma_outliers_window(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = 3.0,
                          keep_flat: bool = False) -> DataFrame:
    """Same labels from window aggregates (one exchange, but a group is one task)."""
    w = Window.partitionBy(*keys)
    labelled = df.withColumn("label", _label(F.col(value), F.avg(value).over(w),
                                             F.stddev_pop(value).over(w), sigmas))
    if not keep_flat:
        labelled = labelled.where(F.col("label") != LABEL_FLAT)
    return labelled


def xor_checksum(df: DataFrame, id_col: str, data) -> DataFrame:
    """Signed XOR of all bytes of ``data`` per row (whole value, no prefix)."""
    folded = df.select(id_col, xor_fold_words(data).alias("_qf"))
    return folded.select(id_col, fold_byte_lanes(F.col("_qf")).alias("checksum"))


def xor_checksum_grouped(df: DataFrame, group_col: str, byte_col: str) -> DataFrame:
    """XOR of byte values (0..255) per group, as a signed byte; partial-capable."""
    v = F.bit_xor(F.col(byte_col).cast("int"))
    return df.groupBy(group_col).agg(F.when(v >= 128, v - 256).otherwise(v).alias("checksum"))
