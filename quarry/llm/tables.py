"""Written intermediate tables and small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.session import scratch_path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    This runs a job. The rows are computed once, later plans start from files
    that every executor can read again after a loss, and both sides of a later
    join start with their own exchange, so adaptive execution can split skewed
    partitions of either.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
