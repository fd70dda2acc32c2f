"""Cross-site boilerplate lines by distinct-site spread.

Every line hash gets a HyperLogLog sketch of the sites it is on; sketches merge
by aggregation, so a line on a third of all documents costs one sketch a task.
Lines whose estimate is clearly above the threshold are boilerplate, those
clearly below are not, and the lines near it get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import cut

LOG2_REGISTERS = 10
# Six standard errors of a sketch of 2^10 registers (1.04 / sqrt(1024) each)
# decide what counts as near the threshold.
MARGIN = 6 * 1.04 / (2 ** (LOG2_REGISTERS / 2))


def _hash(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _occurrences(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """(a, b, site) of every line that is not blank, once per document."""
    line = F.explode(F.array_distinct(F.transform(F.filter(_lines(F.col(text_col)), lambda x: F.trim(x) != ""),
                                                  lambda x: _hash(F.trim(x)))))
    return docs.select(line.alias("h"), F.col(site_col).cast("string").alias("site")).select("h.a", "h.b", "site")


def boilerplate(docs: DataFrame, min_sites: int, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``(a, b, sites)`` of the lines on ``min_sites`` distinct sites or more.

    ``sites`` is exact for lines near the threshold, else the sketch's
    estimate. Lines compare without blanks at their ends; blank lines and null
    texts have none; a null site is no site. Runs a job.
    """
    seen = _occurrences(docs, text_col, site_col).where("site is not null")
    spread = (seen.groupBy("a", "b")
              .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG2_REGISTERS))).alias("about"))
              .where(F.col("about") >= min_sites * (1 - MARGIN) - 1))
    spread = cut(spread, "line-spread")
    near = F.col("about") <= min_sites * (1 + MARGIN) + 1
    # exact counts: sites of the near lines, distinct before they meet
    exact = (seen.join(spread.where(near).select(F.col("a").alias("na"), F.col("b").alias("nb")),
                       (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb")), "left_semi")
             .distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    return cut(spread.where(~near).select("a", "b", F.col("about").alias("sites")).unionAll(exact), "line-boilerplate")


def remove_boilerplate(docs: DataFrame, min_sites: int, id_col: str = "doc_id", text_col: str = "text",
                       site_col: str = "source") -> DataFrame:
    """One row per document row: id, n_lines, n_removed, text without its boilerplate lines.

    The other lines keep their order and blanks. A null text stays null with no
    lines; an empty one has one (blank) line. Rows may share an id or have none:
    a line is boilerplate everywhere or nowhere.
    Empty tables give no rows; other columns are not read.
    """
    bad = boilerplate(docs, min_sites, text_col, site_col).select(F.col("a").alias("ba"), F.col("b").alias("bb"))
    # a row is named by its id and its text's hash, so a null or repeated id gathers no other text's lines
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    here = (docs.select(F.col(id_col).alias("id"), text_hash.alias("th"),
                        F.explode(F.array_distinct(F.transform(_lines(F.col(text_col)), lambda x: _hash(F.trim(x))))).alias("h"))
            .select("id", "th", "h.a", "h.b"))
    # of each document only the hashes to remove, at most its own lines
    drops = (here.join(bad, (F.col("a") == F.col("ba")) & (F.col("b") == F.col("bb")))
             .groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set(F.struct("a", "b")).alias("__drop")))
    drops = cut(drops, "line-drops")
    rows = docs.select(F.col(id_col).alias("id"), text_hash.alias("th"), F.col(text_col).cast("string").alias("text"))
    # the table of drops grows with the corpus: the same shuffled join at every size, never a broadcast
    joined = rows.join(drops.hint("merge"), F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    lines = _lines(F.col("text"))
    kept = F.when(F.col("__drop").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col("__drop"), _hash(F.trim(x)))))
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).cast("long")
    return joined.select(F.col("id").alias(id_col), n.alias("n_lines"),
                         (n - F.coalesce(F.when(F.col("text").isNotNull(), F.size(kept)), F.lit(0))).alias("n_removed"),
                         F.array_join(kept, "\n").alias("text"))
