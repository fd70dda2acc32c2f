"""Text sinks (inventory B1-B3, B7, B8). Writes are parallel: one file per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import static_range_layout


def _joined(cols: Sequence[str], sep: str):
    """One text line of the given columns (null written as empty)."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def write_delimited(df: DataFrame, path: str, cols: Sequence[str], sep: str = "\t",
                    mode: str = "overwrite") -> None:
    """``k <sep> v`` text lines (B1, B3): no quoting, no header."""
    df.select(_joined(cols, sep).alias("value")).write.mode(mode).text(path)


def write_tuples(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """``(k,v)`` lines (B2)."""
    (df.select(F.format_string("(%s,%s)", F.col(key).cast("string"), F.col(value).cast("string"))
               .alias("value"))
     .write.mode(mode).text(path))


def write_lines(df: DataFrame, path: str, col: str = "line", mode: str = "overwrite") -> None:
    """One pre-formatted line per row (B7 reports)."""
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)


def write_total_order(df: DataFrame, path: str, key: str, value: str, n: int = 10,
                      sep: str = "\t", mode: str = "overwrite") -> None:
    """Total-order sorted ``key <sep> value`` output in ``n`` files (G3, B8):
    sampled range partitions over (key, value), each sorted, so the part files
    read in name order are in byte order of the key, then the value, and a hot
    key spreads over files. Duplicates are kept."""
    (df.select(F.col(key).cast("string").alias(key), F.col(value).cast("string").alias(value))
     .repartitionByRange(n, key, value).sortWithinPartitions(key, value)
     .select(_joined([key, value], sep).alias("value"))
     .write.mode(mode).text(path))


def write_static_ranges(df: DataFrame, path: str, key: str, value: str, exact_ten: bool = False,
                        sep: str = "\t", mode: str = "overwrite") -> None:
    """Key-sorted output split by the ten static key ranges.

    Default: one folder per range, each written by many tasks in key order (part
    files in name order are in key order). ``exact_ten`` writes exactly ten files,
    file b holding range b, as ten single-writer tasks.
    """
    laid = static_range_layout(df.select(key, value), key, exact_ten=exact_ten)
    lines = laid.select("bucket", _joined([key, value], sep).alias("value"))
    if exact_ten:
        lines.select("value").write.mode(mode).text(path)
    else:
        lines.write.mode(mode).partitionBy("bucket").text(path)
