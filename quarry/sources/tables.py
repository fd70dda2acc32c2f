"""Parquet tables of the test data layout (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table. Projection and filters applied later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


PIECES = 8          # tasks that an input split is dealt to, so that a task's own counts stay small
WINDOW_PIECES = 32  # the same for count windows: a task holds all counts of its windows, and ranks them


def pieces_of(scan: DataFrame, per_split: int) -> int:
    """Tasks for the rows of ``scan``: ``per_split`` for each input split (whose size is bounded), two per core at least."""
    return max(scan.sparkSession.sparkContext.defaultParallelism * 2, scan.rdd.getNumPartitions() * per_split)


def spread(df: DataFrame, pieces: int = 0) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the scan itself yields
    fewer input splits than there are cores (a small file with one row group).

    Used before CPU-heavy per-row work such as tokenising text. On large inputs
    the scan already has far more splits than cores and this adds nothing;
    ``pieces`` deals every split to so many tasks whatever their number, for
    work whose memory grows with a task's rows (counts of mostly different keys).
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if pieces or df.rdd.getNumPartitions() < target:
        # two partitions per core: rows (documents) vary in size, and a
        # second round of tasks evens out the cores' load
        return df.repartition(pieces_of(df, pieces))
    return df
