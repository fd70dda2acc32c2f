"""Registered queries: the operators applied to the test tables.

Each query is ``(spark, sf_dir) -> DataFrame`` over whole tables. The table
stand-ins follow FIXTURES.md section 2 (documents for text, events for prices,
graphs and count windows, orders/lineitem for the relational jobs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.scalars import static_range_bucket
from quarry.operators import distinct, graph, ordering, relational, stats, text, windows
from quarry.session import scratch_path
from quarry.sinks.text import write_lines
from quarry.sources.tables import PIECES, WINDOW_PIECES, load, pieces_of, spread
from quarry.plans import jobs
from quarry.sources.text import (document_lines, first_two_tokens, key_value_on_tab, n_line_records_per_document,
                                 read_delimited, read_lines, read_multiline_json_objects, text_lines_numbered)

# Parameters of the registered queries.
SUM_HAVING_THRESHOLD = 4_000_000        # header_skip_sum_having
WINDOW_SUM_N = 300                       # count_window_sum / running sum
LINE_WINDOW_N = 10                       # line count windows
GROUP_WINDOW_N = 1000                    # group count windows
TYPE_WINDOW_N = 50                       # windows of the text-keyed cumulative query
TOP_WORDS, TOP_GROUPS, TOP_TYPES = 10, 7, 3
# Key width of the buckets behind row ordinals and running totals (a bucket
# holds at most this many keys; only one row per bucket meets in one task).
DISTINCT_PARTS = 75
ORDINAL_BUCKET_WIDTH: int | str = ordering.AUTO


# --- table stand-ins ------------------------------------------------------

def _docs(spark, d, pieces=0):
    return spread(load(spark, d, "documents").select("doc_id", "text"), pieces)


def _lines(spark, d, pieces=0):
    return document_lines(_docs(spark, d, pieces))


def _events(spark, d):
    return load(spark, d, "events")


def _event_edges(spark, d):
    """(user_id, props.k) as a directed pair list."""
    e = _events(spark, d)
    dst = T.computed_once(F.get_json_object("props", "$.k").try_cast("long"))   # parsed once
    return e.select(F.col("user_id").alias("src"), dst.alias("dst")).where(F.col("dst").isNotNull())


def _event_ordinals(spark, d):
    """events with their arrival ordinal (rank by event_id, 0-based), and the
    row total as a scalar subquery."""
    ev = _events(spark, d)
    return (ordering.bucketed_ordinal(ev, "event_id", out="ord", bucket_width=ORDINAL_BUCKET_WIDTH),
            ev.agg(F.count(F.lit(1))).scalar())


def _line_ordinals(spark, d):
    """Document lines with a global ordinal in (doc_id, line_no) order, and the
    total number of lines as a scalar subquery.

    Only per-document line counts go through the bucketed prefix sum; each
    document gets its offset before its lines are generated, and a line's
    ordinal is that offset plus its line number.
    """
    scan = load(spark, d, "documents").select("doc_id", "text")
    counts = scan.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("_n"))
    offs = ordering.bucketed_running_sum(counts, "doc_id", "_n", "_off", inclusive=False,
                                         bucket_width=ORDINAL_BUCKET_WIDTH)
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    # Join on the scan: it is not a query stage, so adaptive execution cannot
    # turn the text side into the broadcast side; the offsets side is broadcast
    # only when it measures under the threshold (else a sort-merge join on doc_id).
    docs = scan.join(offs.select("doc_id", "_off"), "doc_id")
    lines = docs.select("doc_id", "_off", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return (lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line",
                         (F.col("_off") + F.col("line_no")).alias("ord")), total)


# --- text family --------------------------------------------------------------

def q_word_count(spark, d):
    return text.word_count(_docs(spark, d))


def q_word_count_pig(spark, d):
    return text.script_word_count(_docs(spark, d))


def q_word_count_java_split(spark, d):
    return text.java_split_word_count(_lines(spark, d))


def q_word_count_lower_top10(spark, d):
    return text.lower_word_top(_docs(spark, d), TOP_WORDS)


def q_token_total(spark, d):
    return text.token_total(_docs(spark, d))


def q_bigram_count(spark, d):
    return text.line_bigram_count(_lines(spark, d, PIECES))


def q_bigram_representative(spark, d):
    return text.representative_per_count(text.line_bigram_count(_lines(spark, d, PIECES)))


def q_bigram_sentence(spark, d):
    return text.sentence_bigram_count(_docs(spark, d, PIECES))


def q_bigram_cross_line(spark, d):
    return text.cross_line_bigram_count_per_document(_docs(spark, d))


def q_bigram_cross_line_lines(spark, d):
    """The line-based operator (bucketed successor of each non-empty line)."""
    return text.cross_line_bigram_count(_lines(spark, d))


def q_bigram_count_two_round(spark, d):
    """First round per language, so a bigram has several partial counts; the second round merges them."""
    docs = spread(load(spark, d, "documents").select("lang", "text"), PIECES)
    words = (docs.select("lang", F.explode(F.split("text", "\n")).alias("line"))
             .select("lang", T.cleaned_words(F.col("line")).alias("_w")))
    first = (words.select("lang", F.explode(T.adjacent_pairs(F.col("_w"))).alias("bigram"))
             .groupBy("lang", "bigram").agg(F.count(F.lit(1)).alias("n")))
    return text.reaggregate(first, "bigram")


def q_token_total_two_round(spark, d):
    """Total as the sum of the per-word counts (second round of a two-round job)."""
    return text.total_of_counts(text.word_count(_docs(spark, d)))


def q_two_line_records_grouped(spark, d):
    """The general N-line reader: lines grouped by (document, line_no div 2)."""
    from quarry.sources.text import n_line_records
    return n_line_records(_lines(spark, d), 2)


def q_two_line_records(spark, d):
    return n_line_records_per_document(_docs(spark, d), 2)


def q_json_path_count(spark, d):
    return text.json_path_count(_events(spark, d), "props", "$.k")


def q_integer_total(spark, d):
    return text.integer_total(_docs(spark, d))


def q_multiline_json_count(spark, d):
    """Events written as pretty-printed multi-line JSON objects (``{`` and ``}``
    in column 0), read back object by object; count per ``props.k``."""
    ev = _events(spark, d)
    obj = F.concat(F.lit("{\n  \"event_id\": "), F.col("event_id").cast("string"),
                   F.lit(",\n  \"props\": "), F.col("props"), F.lit("\n}"))
    path = scratch_path(spark, "multiline-json")
    write_lines(ev.select(obj.alias("line")), path)
    objs = read_multiline_json_objects(spark, path, "event_id long, props struct<k: string>")
    tags = objs.where(~F.col("_corrupt")).select(F.col("j.props.k").alias("tag")).where(F.col("tag").isNotNull())
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "tag")


# --- relational family -------------------------------------------------------------

def q_delimited_header_sum_having(spark, d):
    """Orders written as a tab-separated file with a header line, read back with
    a declared schema and the header option, then SUM ... HAVING."""
    path = scratch_path(spark, "orders-tsv")
    orders = load(spark, d, "orders").select("o_custkey", "o_totalprice")
    (orders.select(F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
     .write.option("sep", "\t").option("header", True).csv(path))
    back = read_delimited(spark, path, "o_custkey long, o_totalprice decimal(18,2)", sep="\t", header=True)
    return relational.grouped_sum_having(back, "o_custkey", "o_totalprice", SUM_HAVING_THRESHOLD,
                                         out="total_price")



def q_header_skip_sum_having(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    body = relational.skip_first_rows(orders, "o_orderkey", 1)
    return relational.grouped_sum_having(body, "o_custkey", "o_totalprice",
                                         SUM_HAVING_THRESHOLD, out="total_price")


def q_distinct_pairs_per_source(spark, d):
    li = load(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return relational.distinct_pairs_per_source(
        li.select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("dest")),
        "source", "dest")


def q_address_extract(spark, d):
    e = _events(spark, d)
    addr = F.concat_ws(".", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"),
                       F.col("event_type"), (F.col("event_id") % 256).cast("string"))
    return relational.extract_addresses(e, addr, ["event_id"])


def _firewall_join(spark, d):
    li = load(spark, d, "lineitem")
    orders = load(spark, d, "orders")
    return relational.filtered_join_count(
        li.select("l_orderkey", F.col("l_suppkey").alias("source")), orders,
        "l_orderkey", "o_orderkey", F.col("o_orderstatus") == "F", "source")


def q_filtered_join_count(spark, d):
    return _firewall_join(spark, d)


def q_filtered_join_count_sorted(spark, d):
    counted = _firewall_join(spark, d)
    return ordering.global_rank(counted, [F.desc("n"), F.col("source")], out="rank")


def _orders_stats(spark, d):
    o = load(spark, d, "orders")
    return relational.count_max_argmax(
        o.select(F.col("o_orderpriority").alias("language"), "o_orderkey", "o_totalprice"),
        "language", "o_orderkey", "o_totalprice", "o_orderkey")


def q_count_max_argmax(spark, d):
    return _orders_stats(spark, d).orderBy(F.desc("n"), "language")


def q_fixed_width_report(spark, d):
    return relational.fixed_width_report(_orders_stats(spark, d), "language")


def q_distinct_over_periods(spark, d):
    """Suppliers that ship 75 distinct parts or more, from a store that the years are added to in two deliveries."""
    years = load(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.year("l_shipdate").alias("year"))
    store = scratch_path(spark, "distinct-store")
    for delivery in (F.col("year") < 1996, F.col("year") >= 1996):
        distinct.add_periods(years.where(delivery), "l_suppkey", "l_partkey", "year", store)
    return distinct.reaching(spark, store, DISTINCT_PARTS).select(F.col("source").alias("l_suppkey"), "reaches")


# --- statistics --------------------------------------------------------------------

def _prices(spark, d):
    e = _events(spark, d)
    return e.select(F.col("user_id").alias("ticker"), F.year("ts").cast("long").alias("year"),
                    "event_id", F.col("value").alias("price"))


def q_outlier_3sigma(spark, d):
    """Statistics by partial aggregation, joined back: a hot group is no single task."""
    return stats.sigma_outliers(_prices(spark, d), ["ticker", "year"], "price")


def q_outlier_3sigma_join(spark, d):
    """As ``outlier_3sigma``, whose plan it was first."""
    return q_outlier_3sigma(spark, d)


def q_xor_checksum(spark, d):
    return stats.xor_checksum(_docs(spark, d), "doc_id", F.encode("text", "UTF-8"))


# --- ordering ----------------------------------------------------------------------

def q_total_order_sort(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"),
                                        F.col("o_orderpriority").alias("value"))
    return ordering.total_order_sort(o, "key", ["value"])


def _first_two_tokens(spark, d):
    return first_two_tokens(_lines(spark, d), "line", keep=("doc_id", "line_no"), missing_value="")


def q_static_range_buckets(spark, d):
    words = _docs(spark, d).select(F.explode(T.whitespace_tokens(F.col("text"))).alias("key"))
    return (words.select(static_range_bucket(F.col("key")).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


def q_static_range_sorted(spark, d):
    kv = _first_two_tokens(spark, d)
    return ordering.rank_within_static_range(kv, "key", ["value", "doc_id", "line_no"])


# --- graph -------------------------------------------------------------------------

def q_neighbour_sets(spark, d):
    return graph.neighbour_sets(_event_edges(spark, d))


def q_two_hop_links(spark, d):
    return graph.two_hop_links(_event_edges(spark, d))


def q_common_neighbours(spark, d):
    return graph.common_neighbours(_event_edges(spark, d))


def q_triangle_count(spark, d):
    return graph.triangle_count(_event_edges(spark, d))


def q_triangle_count_by_id(spark, d):
    """Cross-check plan: edges oriented by id instead of degree."""
    return graph.triangle_count_by_id(_event_edges(spark, d))


# --- count windows (batch) -----------------------------------------------------------

def q_count_window_sum(spark, d):
    ev, _ = _event_ordinals(spark, d)
    return windows.count_window_sum(ev, "ord", "value", WINDOW_SUM_N)


def q_count_window_running_sum(spark, d):
    ev, _ = _event_ordinals(spark, d)
    return windows.count_window_running_sum(ev, "ord", "value", WINDOW_SUM_N,
                                            bucket_width=ORDINAL_BUCKET_WIDTH)


def _line_windows(spark, d):
    """Lines with their window, the lines of a window in one task.

    Most words of a window are different, so its lines are far fewer bytes than
    its counts: the lines are shuffled, and the counts made and ranked where
    they are. The windows are spread over the cores by the same shuffle.
    """
    lines, total = _line_ordinals(spark, d)
    n = pieces_of(load(spark, d, "documents").select("doc_id", "text"), WINDOW_PIECES)
    wid = windows.window_id("ord", LINE_WINDOW_N)
    return (lines.select(wid.alias("window_id"), "line").repartition(n, "window_id"),
            windows.is_complete(F.col("window_id"), total, LINE_WINDOW_N))


def q_count_window_word_top10(spark, d):
    lines, ok = _line_windows(spark, d)
    items = lines.select("window_id", F.explode(T.nonword_tokens(F.col("line"))).alias("word"))
    return windows.count_window_top_k(items, ok, "word", TOP_WORDS)


def q_count_window_bigram_top10(spark, d):
    lines, ok = _line_windows(spark, d)
    words = lines.select("window_id", T.sentence_words(F.col("line")).alias("_sw"))
    items = words.select("window_id", F.explode(T.sentence_bigrams_of_words(F.col("_sw"))).alias("bigram"))
    return windows.count_window_top_k(items, ok, "bigram", TOP_WORDS)


def q_count_window_group_top7(spark, d):
    ev, total = _event_ordinals(spark, d)
    return windows.count_window_group_top(ev, "ord", "user_id", "event_id", "value",
                                          GROUP_WINDOW_N, TOP_GROUPS, total_rows=total)


def q_cumulative_group_top7(spark, d):
    ev, total = _event_ordinals(spark, d)
    return windows.cumulative_group_top(ev, "ord", "user_id", "event_id", "value",
                                        GROUP_WINDOW_N, TOP_GROUPS, total_rows=total)


# --- jobs on files written from the tables (actions: they write, then read back) --------------

def q_file_word_count(spark, d):
    """Document lines as text files, counted by the file job, its ``word <tab> n`` output read back."""
    src, out = scratch_path(spark, "lines"), scratch_path(spark, "word-counts")
    write_lines(_lines(spark, d), src)
    jobs.word_count_job(spark, src, out)
    back = key_value_on_tab(read_lines(spark, out))
    return back.select(F.col("key").alias("word"), F.col("value").cast("long").alias("n"))


def q_file_tuple_sink(spark, d):
    """The sorted word count's ``(n,word)`` lines read back."""
    src, out = scratch_path(spark, "lines"), scratch_path(spark, "tuples")
    write_lines(_lines(spark, d), src)
    jobs.sorted_word_count_job(spark, src, out)
    return read_lines(spark, out).select(F.col("value").alias("line"))


def q_file_two_line_records(spark, d):
    """Each language's lines as a folder of part files, each a range of them, read back as two-line records.

    A language can be most of the input, so no task writes or reads all of its lines.
    """
    src = scratch_path(spark, "language-lines")
    docs = load(spark, d, "documents").select("lang", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))
    order = ["lang", "doc_id", "line_no"]
    (docs.repartitionByRange(*order).sortWithinPartitions(*order).select("lang", "value")
     .write.partitionBy("lang").text(src))
    recs = jobs.two_line_records_job(spark, src, folders=True)
    return recs.select(F.regexp_extract("file", "lang=([^/]*)/", 1).alias("lang"), "rec_no", "record")


def q_file_csv_outliers(spark, d):
    """Events as ``ticker,date,price`` lines, labelled by the file job (fields by position, year from the date's text)."""
    src = scratch_path(spark, "prices")
    day = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    write_lines(_events(spark, d).select(F.concat_ws(",", F.col("user_id").cast("string"), day,
                                                     F.col("value").cast("string")).alias("line")), src)
    return jobs.stock_outlier_job(spark, src).select("ticker", "year", "date", "price", "label")


def q_file_total_order(spark, d):
    """Orders as ``key <tab> value`` lines, sorted into range files; rank: the line's place over the files in name order."""
    src, out = scratch_path(spark, "key-values"), scratch_path(spark, "sorted")
    write_lines(load(spark, d, "orders").select(F.concat_ws("\t", F.col("o_orderkey").cast("string"),
                                                            "o_orderpriority").alias("line")), src)
    jobs.total_order_sort_job(spark, src, out)
    lines = text_lines_numbered(spark, out)[0].select("value", (F.col("ord") + 1).alias("rank"))
    kv = F.split("value", "\t", 2)
    return lines.select(kv[0].alias("key"), kv[1].alias("value"), "rank")


def q_file_static_ranges(spark, d):
    """Document lines sorted by first word into ten files, one for each static range: every key's file and place in it."""
    src, out = scratch_path(spark, "lines"), scratch_path(spark, "ranges")
    write_lines(_lines(spark, d), src)
    jobs.static_range_sort_job(spark, src, out, exact_ten=True)
    lines = text_lines_numbered(spark, out)[0]
    return lines.select(F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("bucket"), F.col("line_no").alias("place"),
                        F.split("value", "\t", 2)[0].alias("key"))


def _write_tweets(spark, d):
    """Events as multi-line JSON objects with an array of hashtags, every tenth one malformed."""
    src = scratch_path(spark, "tweets")
    tag = lambda c: F.to_json(F.struct(c.alias("text")))
    tags = F.concat_ws(", ", tag(F.get_json_object("props", "$.k")), tag(F.col("event_type")))
    body = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{ broken "), F.col("event_type"))).otherwise(
        F.concat(F.lit('  "entities": { "hashtags": ['), tags, F.lit("] }")))
    write_lines(_events(spark, d).select(F.concat(F.lit("{\n"), body, F.lit("\n},")).alias("line")), src)
    return src


def q_file_hashtags(spark, d):
    """Quoted hashtags of multi-line JSON objects counted, the malformed ones left out."""
    src, out = _write_tweets(spark, d), scratch_path(spark, "hashtags")
    jobs.hashtag_count_job(spark, src, out, quoted=True)
    n, quoted = F.split("value", "\t", 2)[0], F.split("value", "\t", 2)[1]
    return read_lines(spark, out).select(quoted.alias("tag"), n.cast("long").alias("n"))


def q_file_bad_records(spark, d):
    """The same objects with the malformed ones kept: tags, bad records by their text, and the counts observed meanwhile."""
    counts, kept = jobs.hashtag_count_job(spark, _write_tweets(spark, d), bad=scratch_path(spark, "bad-records"))
    bad = kept.bad.groupBy(F.col("record").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    observed = spark.createDataFrame([("objects", kept.objects), ("malformed", kept.malformed)], "text string, n long")
    kind = lambda df, k: df.select(F.lit(k).alias("kind"), "text", "n")
    return (kind(counts.withColumnRenamed("tag", "text"), "tag").unionByName(kind(bad, "bad record"))
            .unionByName(kind(observed, "observed")))


def q_cumulative_type_top3(spark, d):
    """The cumulative form over a text group key."""
    ev, total = _event_ordinals(spark, d)
    return windows.cumulative_group_top(ev, "ord", "event_type", "event_id", "value",
                                        TYPE_WINDOW_N, TOP_TYPES, total_rows=total)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": q_word_count,
    "word_count_pig": q_word_count_pig,
    "word_count_java_split": q_word_count_java_split,
    "word_count_lower_top10": q_word_count_lower_top10,
    "token_total": q_token_total,
    "bigram_count": q_bigram_count,
    "bigram_representative": q_bigram_representative,
    "bigram_sentence": q_bigram_sentence,
    "bigram_cross_line": q_bigram_cross_line,
    "bigram_cross_line_lines": q_bigram_cross_line_lines,
    "bigram_count_two_round": q_bigram_count_two_round,
    "token_total_two_round": q_token_total_two_round,
    "two_line_records_grouped": q_two_line_records_grouped,
    "two_line_records": q_two_line_records,
    "json_path_count": q_json_path_count,
    "multiline_json_count": q_multiline_json_count,
    "integer_total": q_integer_total,
    "header_skip_sum_having": q_header_skip_sum_having,
    "delimited_header_sum_having": q_delimited_header_sum_having,
    "distinct_pairs_per_source": q_distinct_pairs_per_source,
    "distinct_over_periods": q_distinct_over_periods,
    "address_extract": q_address_extract,
    "filtered_join_count": q_filtered_join_count,
    "filtered_join_count_sorted": q_filtered_join_count_sorted,
    "count_max_argmax": q_count_max_argmax,
    "fixed_width_report": q_fixed_width_report,
    "outlier_3sigma": q_outlier_3sigma,
    "outlier_3sigma_join": q_outlier_3sigma_join,
    "xor_checksum": q_xor_checksum,
    "total_order_sort": q_total_order_sort,
    "static_range_buckets": q_static_range_buckets,
    "static_range_sorted": q_static_range_sorted,
    "neighbour_sets": q_neighbour_sets,
    "two_hop_links": q_two_hop_links,
    "common_neighbours": q_common_neighbours,
    "triangle_count": q_triangle_count,
    "triangle_count_by_id": q_triangle_count_by_id,
    "count_window_sum": q_count_window_sum,
    "count_window_running_sum": q_count_window_running_sum,
    "count_window_word_top10": q_count_window_word_top10,
    "count_window_bigram_top10": q_count_window_bigram_top10,
    "count_window_group_top7": q_count_window_group_top7,
    "cumulative_group_top7": q_cumulative_group_top7,
    "cumulative_type_top3": q_cumulative_type_top3,
    "file_word_count": q_file_word_count,
    "file_tuple_sink": q_file_tuple_sink,
    "file_two_line_records": q_file_two_line_records,
    "file_csv_outliers": q_file_csv_outliers,
    "file_total_order": q_file_total_order,
    "file_static_ranges": q_file_static_ranges,
    "file_hashtags": q_file_hashtags,
    "file_bad_records": q_file_bad_records,
}
