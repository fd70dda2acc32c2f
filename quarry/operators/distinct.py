"""Distinct counts per source over inputs that grow period by period (inventory E7).

A store holds, for each period, the period's distinct (source, dest) pairs and a
mergeable sketch of each source's destinations. Adding a period reads that
period alone. A question over all periods merges the sketches, a small row for
each source and period, and goes back to the stored pairs only for the sources
whose estimate lies near the question's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12               # a sketch of up to 2^12 counters: a relative standard error of about 1.6 %
MARGIN = 0.10           # about six of those


def _name(dest: Column) -> Column:
    """A destination's text, with one for null: a null destination is one of a source's."""
    return F.coalesce(F.concat(F.lit("="), dest.cast("string")), F.lit(""))


def add_periods(pairs: DataFrame, source: str, dest: str, period: str, store: str) -> None:
    """Add the rows of new periods to the store (an action). A period that is there already is replaced, so a delivery
    may be repeated; other periods are neither read nor written. A row without a period belongs to none."""
    spark = pairs.sparkSession
    kept = pairs.where(F.col(period).isNotNull()).select(F.col(source).alias("source"), _name(F.col(dest)).alias("dest"), F.col(period).alias("period")).distinct()
    mode = {"partitionOverwriteMode": "dynamic"}
    kept.write.mode("overwrite").options(**mode).partitionBy("period").parquet(f"{store}/pairs")
    new = [r["period"] for r in kept.select("period").distinct().collect()]      # the periods delivered, few by their nature
    written = _read(spark, store, "pairs").where(F.col("period").isin(new))
    sketches = written.groupBy("source", "period").agg(F.hll_sketch_agg("dest", LG_K).alias("sketch"))
    sketches.write.mode("overwrite").options(**mode).partitionBy("period").parquet(f"{store}/sketches")


def _read(spark: SparkSession, store: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{store}/{table}")


def estimates(spark: SparkSession, store: str) -> DataFrame:
    """``(source, estimate)`` of the distinct destinations over all periods, from the sketches alone."""
    return (_read(spark, store, "sketches").groupBy("source")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")))


def reaching(spark: SparkSession, store: str, threshold: int, margin: float = MARGIN) -> DataFrame:
    """``(source, reaches, n)``: whether a source has ``threshold`` distinct destinations over all periods.

    ``n`` is the exact count, given for sources whose estimate is within
    ``margin`` of the threshold, and decides for them; further off the estimate
    does, which is wrong only if it errs by more than ``margin``.
    """
    guess = estimates(spark, store)
    off = F.abs(F.col("estimate") - threshold) <= margin * threshold
    near = guess.where(off).select(F.col("source").alias("near"))
    exact = (_read(spark, store, "pairs").join(near, F.col("source").eqNullSafe(F.col("near"))).select("near", "dest").distinct()
             .groupBy("near").agg(F.count(F.lit(1)).alias("n")))
    both = guess.join(exact, F.col("source").eqNullSafe(F.col("near")), "left")
    return both.select("source", (F.coalesce("n", "estimate") >= threshold).alias("reaches"), "n")
