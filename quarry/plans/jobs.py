"""End-to-end jobs on raw input files: read the original input format (see
FIXTURES.md section 1), run the operators, optionally write the original output
shape. Every job returns its result DataFrame; ``out`` adds a parallel write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.scalars import address_prefix, xor_of_byte_range
from quarry.operators import graph, relational, stats, text, windows
from quarry.sinks.text import (write_delimited, write_lines, write_static_ranges, write_total_order,
                               write_tuples)
from quarry.sources.tables import WINDOW_PIECES, pieces_of
from quarry.sources.text import (first_two_tokens, key_value_on_tab, n_line_records,
                                 positional_fields, read_delimited, read_lines,
                                 quarantine, read_multiline_json_objects, text_line_ordinals, text_lines_numbered)

# Parameters of the original jobs.
LAND_AREA_THRESHOLD = 200_000_000_000    # a state's summed land area must exceed this
SUM_WINDOW_ROWS = 100                    # integers per count window
TEXT_WINDOW_LINES = 10                   # lines per text count window
TEXT_WINDOW_TOP = 10                     # words or bigrams reported per text window
REPO_WINDOW_ROWS = 200_000               # repository lines per count window
REPO_WINDOW_TOP = 7                      # languages reported per window
SORT_RANGE_FILES = 10                    # output files of the total-order sort
BLOCKED_ACTION = "Blocked"               # firewall action that is counted
TRACE_PROTOCOL = "tcp"                   # protocol kept by the destination count
OUTLIER_SIGMAS = 3.0                     # band half-width in population standard deviations

# The header of the public tract file, and 0-based field positions of the space-separated traces.
GAZ_TRACTS = ("USPS string, GEOID int, POP10 int, HU10 int, ALAND long, AWATER int, "
              "ALAND_SQMI double, AWATER_SQMI double, INTPTLAT float, INTPTLONG float")
FLOW_FIELDS = {"source": (2, "string"), "dest": (4, "string"), "protocol": (5, "string")}
CONNECTION_FIELDS = {"connection": (1, "string"), "source": (2, "string")}
ACTION_FIELDS = {"connection": (0, "string"), "action": (1, "string")}
TWEET = "entities struct<hashtags: array<struct<text: string>>>"


def _lines(spark: SparkSession, src: str) -> DataFrame:
    return read_lines(spark, src).select(F.col("value").alias("line"))


def _file_lines(spark: SparkSession, src: str, folders: bool = False) -> DataFrame:
    """(file, line_no within the file, line, ord over all files); ``folders``: a folder's files are parts of one."""
    lines, _ = text_lines_numbered(spark, src, folders=folders)
    return lines.select("file", "line_no", F.col("value").alias("line"), "ord")


# --- word and n-gram jobs ---------------------------------------------------------

def word_count_job(spark, src, out=None):
    counts = text.word_count(_lines(spark, src), "line")
    if out:
        write_delimited(counts, out, ["word", "n"])
    return counts


def word_total_job(spark, src, out=None):
    total = text.total_of_counts(text.word_count(_lines(spark, src), "line"))
    if out:
        write_lines(total.select(F.col("total").cast("string").alias("line")), out)
    return total


def bigram_frequency_job(spark, src, out=None, representative=False):
    """Cleaned in-line bigrams sorted by frequency (``n <tab> bigram``); with
    ``representative`` one bigram (the smallest) per distinct frequency."""
    counts = text.line_bigram_count(_lines(spark, src))
    result = (text.representative_per_count(counts) if representative
              else counts.select("n", "bigram").orderBy("n", "bigram"))
    if out:
        write_delimited(result, out, ["n", "bigram"])
    return result


def bigram_reaggregate_job(spark, src, out=None):
    """Second counting round (E3): ``w1 w2 <ws> n`` lines from earlier rounds
    (possibly several files per bigram) merged into one count per bigram."""
    toks = F.array_remove(F.split(F.col("value"), r"[ \t\n\r\f]+"), "")
    parts = (read_lines(spark, src).select(toks.alias("_t")).where(F.size("_t") >= 3)
             .select(F.concat_ws(" ", F.col("_t")[0], F.col("_t")[1]).alias("bigram"),
                     F.col("_t")[2].try_cast("long").alias("n")))
    result = text.reaggregate(parts.where(F.col("n").isNotNull()), "bigram")
    if out:
        write_delimited(result, out, ["bigram", "n"])
    return result


def cross_line_bigram_job(spark, src, out=None):
    lines = _file_lines(spark, src).withColumnRenamed("file", "doc_id")
    counts = text.cross_line_bigram_count(lines)
    if out:
        write_delimited(counts, out, ["bigram", "n"])
    return counts


def script_word_count_job(spark, src, out=None):
    counts = text.script_word_count(_lines(spark, src), "line")
    if out:
        write_delimited(counts, out, ["n", "word"])
    return counts


def sorted_word_count_job(spark, src, out=None):
    """Per-line ``\\s+`` split (Java rules), counts sorted ascending, ``(n,word)``."""
    counts = text.java_split_word_count(_lines(spark, src))
    if out:
        write_tuples(counts, out, "n", "word")
    return counts


def hashtag_count_job(spark, src, out=None, descending=False, quoted=False, bad=None):
    """Hashtag counts of multi-line JSON tweets, ascending (``descending`` flips
    it); ``quoted`` renders each tag as JSON text, quotes included. Objects that
    do not parse are left out; with a folder for them in ``bad`` they are kept
    and counted, and ``(counts, Quarantine)`` is returned."""
    objs, kept = read_multiline_json_objects(spark, src, TWEET), None
    if bad:
        kept = quarantine(objs, bad)
        objs = kept.good
    else:
        objs = objs.where(~F.col("_corrupt"))
    tags = objs.select(F.explode("j.entities.hashtags.text").alias("tag"))
    if quoted:
        tags = tags.select(T.quoted(F.col("tag")).alias("tag"))
    counts = tags.where(F.col("tag").isNotNull()).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    result = counts.orderBy(F.desc("n") if descending else F.col("n"), "tag")
    if out:
        write_delimited(result, out, ["n", "tag"])
    return (result, kept) if bad else result


def two_line_records_job(spark, src, out=None, n=2, folders=False):
    """Every ``n`` lines of a file (with ``folders``, of a folder's files one after the other) as one record."""
    records = n_line_records(_file_lines(spark, src, folders), n, group_cols=("file",))
    if out:
        write_delimited(records, out, ["rec_no", "record"])
    return records


def integer_total_job(spark, src):
    """Sum of the all-digit ``\\W+`` tokens of every line."""
    return text.integer_total(_lines(spark, src), "line")


# --- relational jobs ----------------------------------------------------------------

def land_area_job(spark, src, out=None, threshold=LAND_AREA_THRESHOLD):
    tracts = read_delimited(spark, src, GAZ_TRACTS, sep="\t", header=True)
    result = relational.grouped_sum_having(tracts, "USPS", "ALAND", threshold,
                                           out="land", decimal=None)
    if out:
        write_delimited(result, out, ["USPS", "land"])
    return result


def distinct_destinations_job(spark, src, out=None, protocol=TRACE_PROTOCOL):
    trace = positional_fields(read_lines(spark, src), " ", FLOW_FIELDS)
    flows = (trace.where(T.full_match(F.col("protocol"), protocol))
             .select(address_prefix(F.col("source")).alias("source"), address_prefix(F.col("dest")).alias("dest")))
    result = relational.distinct_pairs_per_source(flows, "source", "dest")
    if out:
        write_delimited(result, out, ["n", "source"])
    return result


def firewall_job(spark, ip_trace, raw_block, out=None, action=BLOCKED_ACTION):
    connections = positional_fields(read_lines(spark, ip_trace), " ", CONNECTION_FIELDS)
    actions = positional_fields(read_lines(spark, raw_block), " ", ACTION_FIELDS)
    counts = relational.filtered_join_count(connections, actions, "connection", "connection",
                                            T.full_match(F.col("action"), action), "source")
    result = counts.orderBy(F.desc("n"), "source")
    if out:
        write_delimited(result, out, ["source", "n"])
    return result


def stock_outlier_job(spark, src, out=None, sigmas=OUTLIER_SIGMAS):
    prices = positional_fields(read_lines(spark, src), ",",
                               {"ticker": (0, "string"), "date": (1, "string"), "price": (2, "double")})
    keyed = prices.where(F.col("price").isNotNull()).withColumn("year", F.substring("date", 1, 4))
    result = stats.sigma_outliers(keyed, ["ticker", "year"], "price", sigmas)
    if out:
        write_lines(result.select(F.format_string("(%s,%s,%s,%s,%s)", "ticker", "year", "date", "price",
                                                  "label").alias("line")), out)
    return result


def _repos(spark, src):
    """Repository CSV lines: repo (field 0), language (1), stars (12), and the
    line's ordinal (load order, the tie key for the most-starred repository);
    and the number of lines, as a scalar over one row per input split."""
    lines, blocks = text_lines_numbered(spark, src)
    return (positional_fields(lines, ",", {"repo": (0, "string"), "language": (1, "string"), "stars": (12, "long")},
                              keep=("ord",)),
            blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar())


def language_report_job(spark, src, out=None):
    """Per language: repository count, most-starred repository and its stars,
    most repositories first, as fixed-width lines (earliest line wins a tie)."""
    repos = _repos(spark, src)[0].where(F.col("stars").isNotNull())
    result = relational.count_max_argmax(repos, "language", "repo", "stars", "ord").orderBy(F.desc("n"), "language")
    lines = relational.fixed_width_report(result, "language")
    if out:
        write_lines(lines, out)
    return lines


def triangle_job(spark, src):
    edges = read_delimited(spark, src, "src string, dst string", sep="\t")
    return graph.triangle_count(edges.where(F.col("dst").isNotNull()))


def citation_jobs(spark, src):
    """(neighbour sets, two-hop links) of whitespace-separated citation pairs."""
    pairs = first_two_tokens(read_lines(spark, src))
    edges = pairs.select(F.col("key").try_cast("long").alias("src"),
                         F.col("value").try_cast("long").alias("dst")).dropna()
    return graph.neighbour_sets(edges), graph.two_hop_links(edges)


# --- ordering jobs ----------------------------------------------------------------------

def total_order_sort_job(spark, src, out, n=SORT_RANGE_FILES):
    write_total_order(key_value_on_tab(read_lines(spark, src)), out, "key", "value", n=n)


def static_range_sort_job(spark, src, out, exact_ten=False):
    pairs = first_two_tokens(read_lines(spark, src), missing_value="")
    write_static_ranges(pairs, out, "key", "value", exact_ten=exact_ten)


# --- count-window jobs (batch over a file's line order) ---------------------------------

def window_sum_job(spark, src, n=SUM_WINDOW_ROWS, running=False):
    """One integer per line; sums of complete windows of ``n`` lines (or the
    running total after each)."""
    lines = text_line_ordinals(spark, src).select(
        "ord", F.trim("value").try_cast("decimal(18,2)").alias("value"))
    if running:
        return windows.count_window_running_sum(lines, "ord", "value", n)
    return windows.count_window_sum(lines, "ord", "value", n)


def window_top_job(spark, src, n=TEXT_WINDOW_LINES, k=TEXT_WINDOW_TOP, bigrams=False):
    """Top-k words (case kept) or in-sentence bigrams (lower-cased) of every
    complete window of ``n`` lines."""
    lines, blocks = text_lines_numbered(spark, src)
    total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()      # one row per input split
    # a window's lines are fewer bytes than its counts: they are shuffled, in tasks that hold few windows' counts
    keyed = (lines.select(windows.window_id("ord", n).alias("window_id"), "value")
             .repartition(pieces_of(read_lines(spark, src), WINDOW_PIECES), "window_id"))
    if bigrams:
        words = keyed.select("window_id", T.sentence_words(F.col("value")).alias("_sw"))
        items = words.select("window_id", F.explode(T.sentence_bigrams_of_words(F.col("_sw"))).alias("item"))
    else:
        items = keyed.select("window_id", F.explode(T.nonword_tokens(F.col("value"))).alias("item"))
    return windows.count_window_top_k(items, windows.is_complete(F.col("window_id"), total, n), "item", k)


def language_window_top_job(spark, src, n=REPO_WINDOW_ROWS, k=REPO_WINDOW_TOP, cumulative=False):
    """Per complete window of ``n`` repository lines (or cumulatively): count,
    most stars and its repository per language; the top-k languages."""
    repos, total = _repos(spark, src)
    op = windows.cumulative_group_top if cumulative else windows.count_window_group_top
    return op(repos, "ord", "language", "repo", "stars", n, k, total_rows=total)


# --- bytes --------------------------------------------------------------------------------

def file_xor_job(spark, path, offset, length):
    """XOR of ``length`` bytes from ``offset`` of each file, as a signed byte."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", xor_of_byte_range(F.col("content"), offset, length).alias("checksum"))
