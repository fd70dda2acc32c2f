"""Structured Streaming forms of the running-count and count-window jobs
(inventory A10, B4-B6, J1-J10, K6, K7).

Streams read parquet tables (schema taken from the file footer, never inferred
from rows) or folders of text files with ``readStream``, run with
``trigger(availableNow=True)``, and bound a micro-batch by bytes. Rows are
combined per Arrow batch (stateless ``mapInPandas``, bounded memory) before a
state shuffle, so a hot key ships a row per batch. State rows stay small: one
total per word, one partial per open window. No sink needs a driver callback
server:

* running counts are the engine's own aggregation in update mode, and their
  result is read from the state store;
* append-mode streams (stateful count windows) write to the parquet file sink, which commits each micro-batch exactly once through
  its metadata log;
* complete-mode summaries whose size is fixed by the query (a top-k, a grand
  total) go to the memory sink.

Updates themselves and micro-batches with a manifest go to the sinks of
``quarry.streaming.sinks``. Streams run in fresh folders, or in one named by
``at``, where a later run goes on.

Stream state and file outputs live under the shared checkpoint folder; state is
kept in RocksDB whatever session the caller brings. The registered query
functions run the stream to the end and return a DataFrame over what the sink,
or for running counts the state store, holds.

Order. A stream's tasks see rows in no fixed order, so count windows count by a
sequence number that the rows carry or that follows from their place: events by
``event_id``; lines by (document id, line number), through a static table of
each document's first ordinal, or by (file path, line number) for text files,
whose lines are numbered and written before they are streamed.
"""

from __future__ import annotations

import sys
import uuid
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.functions import text as T
from quarry.operators.text import limb_sums, total_of_limbs
from quarry.session import scratch_path
from quarry.sources.tables import table_path
from quarry.streaming import sinks
from quarry.streaming.cumulative import cumulative_top_stream
from quarry.streaming.sinks import finish as _finish
from quarry.streaming.sinks import prepare as _prepare

DEFAULT_WINDOW_N = 300
BYTES_PER_TRIGGER = 10 << 30   # input of one micro-batch, one file at least

# The state functions below run in Python workers; ship them by value so the
# workers never need this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _quiet() -> None:
    """Runs in the Python worker: PySpark's Arrow serializer warns when a state
    function emits no rows for a key (an incomplete window), which is intended."""
    warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation with empty",
                            category=FutureWarning)


# --- sources and sinks -----------------------------------------------------------

def stream_table(spark: SparkSession, sf_dir: str, name: str, bytes_per_trigger: int | None = None,
                 spread: bool = False) -> DataFrame:
    """A parquet table as a bounded file stream (A10).

    ``spread`` round-robins the rows over the cores when a batch scan of the
    same files has fewer splits than cores (as ``sources.tables.spread`` does
    for batch scans), for CPU-heavy per-row work such as tokenising.
    """
    path = table_path(sf_dir, name)
    batch = spark.read.parquet(path)
    glob = path[:-1] + "[" + path[-1] + "]"   # a glob, so a single file is accepted as a stream source
    stream = (spark.readStream.schema(batch.schema)
              .option("maxBytesPerTrigger", bytes_per_trigger or BYTES_PER_TRIGGER)
              .parquet(glob))
    target = spark.sparkContext.defaultParallelism
    if spread and batch.rdd.getNumPartitions() < target:
        return stream.repartition(target)
    return stream


def stream_text(spark: SparkSession, path: str, bytes_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files as a stream of lines (``value``), A10."""
    return spark.readStream.option("maxBytesPerTrigger", bytes_per_trigger or BYTES_PER_TRIGGER).text(path)


def _places(spark: SparkSession, label: str, at: str | None) -> tuple[str, str]:
    """(output folder, checkpoint folder) of a stream: fresh ones, or those named ``label`` under ``at``."""
    if at is None:
        return scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")
    return f"{at.rstrip('/')}/{label}/out", f"{at.rstrip('/')}/{label}/state"


def run_to_files(stream: DataFrame, label: str, fmt: str = "parquet", at: str | None = None) -> str:
    """Run an append-mode ``stream`` over everything available into a file sink
    (``parquet``, ``json`` or ``csv``: B4); return the output folder.

    ``at`` names a folder for the output and the checkpoint: a later run with
    the same one goes on where the last stopped, reads only files that came
    since, and completes the windows that were open.
    """
    spark = stream.sparkSession
    _prepare(spark)
    out, state = _places(spark, label, at)
    q = (stream.writeStream.outputMode("append").format(fmt)
         .option("path", out)
         .option("checkpointLocation", state)
         .trigger(availableNow=True)
         .start())
    _finish(q)
    return out


def run_to_memory(stream: DataFrame, label: str) -> DataFrame:
    """Run a complete-mode ``stream`` whose result size is bounded by the query
    (top-k, totals) into the memory sink; return the final result table."""
    spark = stream.sparkSession
    _prepare(spark)
    name = f"quarry_{label.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    q = (stream.writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
         .trigger(availableNow=True)
         .start())
    _finish(q)
    return spark.table(name)


def _read_sink(spark: SparkSession, out: str, schema: str | StructType) -> DataFrame:
    """What a stream wrote to its parquet sink; a stream without rows leaves a folder without data files, and
    anything that cannot be read is an error."""
    return spark.read.schema(schema).parquet(out)


# --- J1: keyed running count, one update per key per micro-batch -------------------

def running_counts(tokens: DataFrame, key: str) -> DataFrame:
    """Streaming running count per ``key``: the engine's aggregation, partial per
    task, with one state row (one number) per key however large the vocabulary.
    In update mode any sink gets each touched key's new count once per micro-batch."""
    return tokens.groupBy(F.col(key).alias("word")).agg(F.count(F.lit(1)).alias("n"))


def run_to_state(counts: DataFrame, label: str, at: str | None = None) -> DataFrame:
    """Run a ``running_counts`` stream over everything available; its counts, read from the state store.
    ``at``: as for ``run_to_files``.

    The updates themselves go nowhere; what the stream has counted is its state
    of the last micro-batch, a distributed table in the checkpoint folder.
    """
    spark = counts.sparkSession
    _prepare(spark)
    state = _places(spark, label, at)[1]
    q = (counts.writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", state).trigger(availableNow=True).start())
    _finish(q)
    kept = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/state")
    if not kept.getFileSystem(spark._jsc.hadoopConfiguration()).exists(kept):       # no micro-batch ever ran
        return spark.createDataFrame([], counts.schema)
    return spark.read.format("statestore").load(state).select("key.word", F.col("value.count").alias("n"))


def word_counts_of(tokens: DataFrame, label: str, at: str | None = None) -> DataFrame:
    """Run a stream of ``word`` rows as running counts; the final count per word."""
    return run_to_state(running_counts(tokens, "word"), label, at)


def _word_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stream_table(spark, sf_dir, "documents", spread=True)
    return docs.select(F.explode(T.whitespace_tokens(F.col("text"))).alias("word"))


def stream_word_count(spark: SparkSession, sf_dir: str, at: str | None = None) -> DataFrame:
    return word_counts_of(_word_stream(spark, sf_dir), "stream-word-count", at)


def word_count_updates(spark: SparkSession, sf_dir: str, at: str | None = None) -> DataFrame:
    """J1's updates themselves: ``(word, n, epoch)``, the running count of every word that a micro-batch touched."""
    counts = running_counts(_word_stream(spark, sf_dir), "word")
    log, state = _places(spark, "stream-word-updates", at)
    sinks.run_to_updates(counts, log, state)
    return sinks.read_update_log(spark, log, state, counts.schema)


def stream_word_count_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last update of every word."""
    last = F.max(F.struct("epoch", "n")).alias("_l")
    return word_count_updates(spark, sf_dir).groupBy("word").agg(last).select("word", F.col("_l.n").alias("n"))


def stream_text_word_count(spark: SparkSession, src: str) -> DataFrame:
    """J1 on a folder of text files: running whitespace-token counts."""
    words = stream_text(spark, src).select(F.explode(T.whitespace_tokens(F.col("value"))).alias("word"))
    return word_counts_of(words, "stream-text-word-count")


# --- J2 / B5: ranked summary at the end of the stream ---------------------------------

def top_k_of(items: DataFrame, col: str, k: int, label: str) -> DataFrame:
    """Complete-mode count of ``col`` with the k most frequent at the end of the
    stream (ties by value); only k rows reach the memory sink."""
    ranked = (items.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), col).limit(k))
    return run_to_memory(ranked, label)


def stream_top_words(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    docs = stream_table(spark, sf_dir, "documents", spread=True)
    words = docs.select(F.explode(T.nonword_tokens(F.lower(F.col("text")))).alias("word"))
    return top_k_of(words, "word", k, "stream-top")


def stream_text_top_words(spark: SparkSession, src: str, k: int = 10) -> DataFrame:
    """J2 on text files: lower-cased ``\\W+`` words, the k most frequent."""
    lines = stream_text(spark, src)
    words = lines.select(F.explode(T.nonword_tokens(F.lower(F.col("value")))).alias("word"))
    return top_k_of(words, "word", k, "stream-text-top")


def stream_text_top_bigrams(spark: SparkSession, src: str, k: int = 10) -> DataFrame:
    """J2 for in-sentence bigrams of text files (lower-cased), the k most frequent."""
    sw = stream_text(spark, src).select(T.sentence_words(F.col("value")).alias("_sw"))
    bigrams = sw.select(F.explode(T.sentence_bigrams_of_words(F.col("_sw"))).alias("bigram"))
    return top_k_of(bigrams, "bigram", k, "stream-text-bigrams")


# --- J3 / B6: one total at the end of the stream --------------------------------------

def integer_total_of(lines: DataFrame, col: str, label: str) -> DataFrame:
    """Grand total of the all-digit ``\\W+`` tokens, exact for any length: complete-mode
    limb sums (a row per 18 digits of the longest token), carried at the end."""
    return total_of_limbs(run_to_memory(limb_sums(lines, col), label))


def stream_integer_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integer_total_of(stream_table(spark, sf_dir, "documents", spread=True), "text", "stream-total")


def stream_text_integer_total(spark: SparkSession, src: str) -> DataFrame:
    """J3 on text files."""
    return integer_total_of(stream_text(spark, src), "value", "stream-text-total")


# --- J4 / J5 / J8: count windows with explicit state -------------------------------------

_WINDOW_STATE = "n long, cents long"
_WINDOW_OUT = "window_id long, cents long"


def _window_combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One (window_id, rows, cents) row per window of an Arrow batch."""
    _quiet()
    for pdf in batches:
        yield (pdf.groupby("window_id").agg(rows=("cents", "size"), cents=("cents", "sum")).reset_index()
               .astype({"window_id": "int64", "rows": "int64", "cents": "int64"}))


def _window_state_fn(n: int):
    """Accumulate (rows, cents) per window id; emit and forget the window the
    moment it holds ``n`` rows, so state only holds windows still open."""

    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _quiet()
        rows, cents = state.get if state.exists else (0, 0)
        for pdf in batches:
            rows += int(pdf["rows"].sum())
            cents += int(pdf["cents"].sum())
        if rows >= n:
            state.remove()
            yield pd.DataFrame({"window_id": [int(key[0])], "cents": [cents]})
        else:
            state.update((rows, cents))
    return fn


def count_window_stream(values: DataFrame, seq: Column, cents: Column, n: int) -> DataFrame:
    """Windows of ``n`` consecutive sequence numbers; a window is emitted once,
    when complete; an incomplete last window never is (J5). ``seq`` and ``cents``
    are any columns of the stream."""
    keyed = values.select((F.floor(seq / F.lit(n))).cast("long").alias("window_id"), cents.alias("cents"))
    partial = keyed.mapInPandas(_window_combine, "window_id long, rows long, cents long")
    return partial.groupBy("window_id").applyInPandasWithState(
        _window_state_fn(n), _WINDOW_OUT, _WINDOW_STATE, "append", GroupStateTimeout.NoTimeout)


def _event_cents(events: DataFrame) -> Column:
    return (F.col("value").cast("decimal(18,2)") * 100).cast("long")


def _cents_to_double(c: str) -> Column:
    return (F.col(c).cast("decimal(20,0)") / F.lit(100)).cast("decimal(18,2)").cast("double")


def _event_windows(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``event_id`` is the arrival sequence (dense from 0) of the event stream."""
    ev = stream_table(spark, sf_dir, "events")
    return count_window_stream(ev, F.col("event_id"), _event_cents(ev), n)


def stream_count_window_sum(spark: SparkSession, sf_dir: str, n: int = DEFAULT_WINDOW_N, at: str | None = None) -> DataFrame:
    out = run_to_files(_event_windows(spark, sf_dir, n), "stream-window", at=at)
    sink = _read_sink(spark, out, _WINDOW_OUT)
    return sink.select("window_id", _cents_to_double("cents").alias("total"))


def stream_count_window_log(spark: SparkSession, sf_dir: str, n: int = DEFAULT_WINDOW_N, at: str | None = None) -> DataFrame:
    """The windows' sums through the sink that commits each micro-batch with a manifest (K7)."""
    windows = _event_windows(spark, sf_dir, n)
    log, state = _places(spark, "stream-window-log", at)
    sinks.run_to_commit_log(windows, log, state)
    return sinks.read_commit_log(spark, log, windows.schema).select("window_id", _cents_to_double("cents").alias("total"))


RUNNING_FAN = 1024     # windows whose running total is kept by one key
_RUNNING_STATE = "next long, total long, waiting_ids array<long>, waiting_cents array<long>"


def _running_total(fan: int):
    """Per bucket of ``fan`` consecutive windows: the total from the bucket's first window on, in their order;
    a window that comes early waits for those before it in its bucket only."""

    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _quiet()
        nxt, total, ids, cents = state.get if state.exists else (int(key[0]) * fan, 0, [], [])
        waiting = dict(zip(ids, cents))
        for pdf in batches:
            waiting.update(zip(pdf["window_id"].tolist(), pdf["cents"].tolist()))
        out_ids, out = [], []
        while nxt in waiting:
            total += waiting.pop(nxt)
            out_ids.append(nxt)
            out.append(total)
            nxt += 1
        if nxt < (int(key[0]) + 1) * fan:
            state.update((nxt, total, list(waiting), list(waiting.values())))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({"window_id": out_ids, "cents": out})
    return fn


def running_sum_stream(windows: DataFrame, fan: int = RUNNING_FAN) -> DataFrame:
    """Running totals inside buckets of ``fan`` windows, emitted while the stream runs (J8). A full bucket's state
    is dropped; no key sees more than ``fan`` windows."""
    return windows.withColumn("bucket", F.expr(f"window_id div {fan}")).groupBy("bucket").applyInPandasWithState(
        _running_total(fan), _WINDOW_OUT, _RUNNING_STATE, "append", GroupStateTimeout.NoTimeout)


def running_totals(spark: SparkSession, windows: str, label: str, at: str | None = None, fan: int = RUNNING_FAN) -> DataFrame:
    """``(window_id, cents)``: the running total after each window in the sink folder ``windows``.

    Level by level: totals inside buckets of ``fan`` windows are a stream over
    the windows' sink; a full bucket's total is one row of the next level, whose
    stream adds up buckets inside buckets of ``fan`` buckets, and so on as long
    as a level has filled a bucket. A window's running total is its total in
    its bucket and, from each level above, that of the bucket before; it is
    there as soon as those are.
    """
    sinks_by_level = [windows]
    while True:
        below = (spark.readStream.schema(_WINDOW_OUT).option("maxBytesPerTrigger", BYTES_PER_TRIGGER)
                 .parquet(sinks_by_level[-1]))
        if len(sinks_by_level) > 1:
            below = _full_buckets(below, fan)
        sinks_by_level.append(run_to_files(running_sum_stream(below, fan), f"{label}-{len(sinks_by_level)}", at=at))
        if not _full_buckets(_read_sink(spark, sinks_by_level[-1], _WINDOW_OUT), fan).take(1):
            break
    out = _read_sink(spark, sinks_by_level[1], _WINDOW_OUT)
    for level, sink in enumerate(sinks_by_level[2:], 1):
        place = F.expr(f"window_id div {fan ** level}")         # the window's bucket; those before it in its own bucket count
        before = _read_sink(spark, sink, _WINDOW_OUT).select((F.col("window_id") + 1).alias("_at"), F.col("cents").alias("_before"))
        none = F.col("_place") % fan == 0
        out = (out.withColumn("_place", place).join(before, F.col("_place") == F.col("_at"), "left")
               .where(none | F.col("_before").isNotNull())
               .select("window_id", (F.col("cents") + F.when(none, F.lit(0)).otherwise(F.col("_before"))).alias("cents")))
    return out.where(F.col("window_id") < fan ** (len(sinks_by_level) - 1))      # further on, a bucket before is not full yet


def _full_buckets(totals: DataFrame, fan: int) -> DataFrame:
    """A full bucket's total is that after its last window."""
    return totals.where(F.col("window_id") % fan == fan - 1).select(F.expr(f"window_id div {fan}").alias("window_id"), "cents")


def stream_count_window_running_sum(spark: SparkSession, sf_dir: str, n: int = DEFAULT_WINDOW_N,
                                    at: str | None = None, fan: int = RUNNING_FAN) -> DataFrame:
    """Running total after each complete window of events: the windows' sums are
    one stream, the running totals over them others that read its sink."""
    out = run_to_files(_event_windows(spark, sf_dir, n), "stream-windows", at=at)
    totals = running_totals(spark, out, "stream-running", at, fan)
    return totals.select("window_id", _cents_to_double("cents").alias("running_total"))


# --- J6 / J7: top items of line windows -----------------------------------------------------

WINDOW_BLOCK = 256      # windows that share a state key
_TOP_STATE = "windows array<long>, lines array<long>, item_windows array<long>, items array<string>, counts array<long>"


def _line_window_fn(n: int, k: int):
    """State of a block of windows: of those still open, the lines seen and the counts of their items (at most
    ``n`` lines' items each). Emits the top k of a window and forgets it at ``n`` lines."""

    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _quiet()
        windows, lines, item_windows, items, counts = state.get if state.exists else ([], [], [], [], [])
        seen = [pd.Series(lines, index=windows, dtype="int64")] if windows else []
        held = [pd.DataFrame({"window_id": item_windows, "item": items, "n": counts}).astype({"window_id": "int64", "n": "int64"})]
        for pdf in batches:
            seen.append(pdf["window_id"].value_counts())
            each = pdf.explode("items").dropna(subset=["items"]).rename(columns={"items": "item"})
            held.append(each.groupby(["window_id", "item"], sort=False).size().rename("n").reset_index())
        total = pd.concat(seen).groupby(level=0).sum()
        each = pd.concat(held, ignore_index=True).groupby(["window_id", "item"], as_index=False, sort=False)["n"].sum()
        done = total.index[total >= n]
        closed = each["window_id"].isin(done)
        total, open_ = total.drop(done), each[~closed]
        if len(total):
            state.update((total.index.tolist(), total.tolist(), open_["window_id"].tolist(), open_["item"].tolist(), open_["n"].tolist()))
        elif state.exists:
            state.remove()
        top = each[closed].sort_values(["window_id", "n", "item"], ascending=[True, False, True]).groupby("window_id").head(k)
        if len(top):
            rank = top.groupby("window_id").cumcount() + 1
            yield top.assign(rank=rank).astype({"window_id": "int64", "n": "int64", "rank": "int64"})[["window_id", "item", "n", "rank"]]
    return fn


def line_window_top_stream(lines: DataFrame, ordinal: Column, items: Column, n: int, k: int) -> DataFrame:
    """``(window_id, item, n, rank)`` of every complete window of ``n`` lines, ties by item.

    ``ordinal`` numbers the lines densely from 0, ``items`` is the array of a
    line's items. A line is one row into the state, with all its items; a task
    counts whole blocks of ``WINDOW_BLOCK`` windows at once.
    """
    keyed = lines.select(F.floor(ordinal / F.lit(n)).cast("long").alias("window_id"), items.alias("items"))
    return keyed.withColumn("block", F.expr(f"window_id div {WINDOW_BLOCK}")).groupBy("block").applyInPandasWithState(
        _line_window_fn(n, k), "window_id long, item string, n long, rank long", _TOP_STATE, "append",
        GroupStateTimeout.NoTimeout)


def _numbered_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of document lines with their ordinal in (doc_id, line number)
    order: each document's first ordinal is a static prefix sum of line counts."""
    from quarry.operators.ordering import bucketed_running_sum

    counts = spark.read.parquet(table_path(sf_dir, "documents")).select(
        "doc_id", F.size(F.split("text", "\n")).cast("long").alias("_n"))
    first = bucketed_running_sum(counts, "doc_id", "_n", "_first", inclusive=False).select("doc_id", "_first")
    docs = stream_table(spark, sf_dir, "documents", spread=True).select("doc_id", "text").join(first, "doc_id")
    return docs.select("_first", F.posexplode(F.split("text", "\n")).alias("_line", "line")).select(
        (F.col("_first") + F.col("_line")).alias("ord"), "line")


def _numbered_file_lines(spark: SparkSession, src: str) -> DataFrame:
    """The stream of a text folder's lines with their ordinal in (file path, line
    number) order: the lines as the text reader cuts them (LF, CR LF or a lone
    CR), numbered and written once, whatever the files' size, and streamed from
    there."""
    from quarry.sources.text import text_lines_numbered

    at = scratch_path(spark, "numbered-lines")
    text_lines_numbered(spark, src)[0].select("ord", F.col("value").alias("line")).write.parquet(at)
    return spark.readStream.schema("ord long, line string").option("maxBytesPerTrigger", BYTES_PER_TRIGGER).parquet(at)


def _line_window_top(spark: SparkSession, lines: DataFrame, n: int, k: int, bigrams: bool, label: str) -> DataFrame:
    if bigrams:
        lines = lines.select("ord", T.sentence_words(F.col("line")).alias("_sw"))
        items, name = T.sentence_bigrams_of_words(F.col("_sw")), "bigram"
    else:
        items, name = T.nonword_tokens(F.col("line")), "word"
    out = run_to_files(line_window_top_stream(lines, F.col("ord"), items, n, k), label)
    return _read_sink(spark, out, "window_id long, item string, n long, rank long").select(
        "window_id", F.col("item").alias(name), "n", "rank")


def stream_count_window_word_top(spark: SparkSession, sf_dir: str, n: int = 10, k: int = 10) -> DataFrame:
    """The k most frequent words of every complete window of n document lines."""
    return _line_window_top(spark, _numbered_document_lines(spark, sf_dir), n, k, False, "stream-line-words")


def stream_count_window_bigram_top(spark: SparkSession, sf_dir: str, n: int = 10, k: int = 10) -> DataFrame:
    """The k most frequent in-sentence bigrams of every complete window of n document lines."""
    return _line_window_top(spark, _numbered_document_lines(spark, sf_dir), n, k, True, "stream-line-bigrams")


def stream_text_window_top(spark: SparkSession, src: str, n: int = 10, k: int = 10, bigrams: bool = False) -> DataFrame:
    """J6 / J7 on a folder of text files."""
    return _line_window_top(spark, _numbered_file_lines(spark, src), n, k, bigrams, "stream-text-window")


def stream_text_window_sum(spark: SparkSession, src: str, n: int = 100, running: bool = False) -> DataFrame:
    """J4 / J8 on a folder of text files, one integer per line: the sum of every
    complete window of n lines, or the running total after it. A line that is no
    integer fails the stream."""
    lines = _numbered_file_lines(spark, src)
    out = run_to_files(count_window_stream(lines, F.col("ord"), F.trim("line").cast("long"), n), "stream-text-sums")
    if running:
        return running_totals(spark, out, "stream-text-running").withColumnRenamed("cents", "running_total")
    return _read_sink(spark, out, _WINDOW_OUT).withColumnRenamed("cents", "total")


# --- J9: per-window group count / max / argmax, top-k groups -----------------------------

def _best(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per (window, group): row count, and the earliest row with the largest value."""
    lead = pdf.sort_values(["value", "ord"], ascending=[False, True]).drop_duplicates(["window_id", "grp"])
    counts = pdf.groupby(["window_id", "grp"], as_index=False, dropna=False)["n"].sum()
    return lead.drop(columns="n").merge(counts, on=["window_id", "grp"])[["window_id", "grp", "n", "value", "ord", "item"]]


def _group_combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``_best`` of every Arrow batch."""
    _quiet()
    for pdf in batches:
        yield _best(pdf.assign(n=1).astype({"n": "int64"}))


def _window_partials_fn(n: int):
    """State per open window: rows seen and its groups' partials, as typed
    arrays. At most ``n`` rows ever reach one window, so the state is bounded;
    it is dropped on completion, when every group's partial is emitted."""

    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        _quiet()
        parts = list(batches)                               # at most n rows of this window
        rows = sum(int(p["n"].sum()) for p in parts)
        if state.exists:
            seen, *columns = state.get
            rows += seen
            parts.append(pd.DataFrame(dict(zip(("grp", "n", "value", "ord", "item"), columns))).assign(window_id=key[0]))
        held = _best(pd.concat(parts, ignore_index=True))
        if rows < n:
            state.update((rows, *(held[c].tolist() for c in ("grp", "n", "value", "ord", "item"))))
            return
        if state.exists:
            state.remove()
        yield held
    return fn


def window_partials_stream(rows: DataFrame, seq: str, group: str, item: str, value: str, n: int) -> DataFrame:
    """Per complete window of ``n`` sequence numbers: every group's count, max
    value, and the item of the earliest row holding it (J9/J10 partials), as
    ``(window_id, grp, n, value, ord, item)``. Columns of any type: groups and
    items pass the state as text, where pandas keeps their nulls."""
    kinds = rows.select(F.col(group).alias("grp"), F.col(item).alias("item")).schema
    keyed = rows.select(F.floor(F.col(seq) / F.lit(n)).cast("long").alias("window_id"),
                        F.col(group).cast("string").alias("grp"), F.col(value).cast("double").alias("value"),
                        F.col(seq).cast("long").alias("ord"), F.col(item).cast("string").alias("item"))
    out = "window_id long, grp string, n long, value double, ord long, item string"
    state = "rows long, grp array<string>, n array<long>, value array<double>, ord array<long>, item array<string>"
    parts = keyed.mapInPandas(_group_combine, out).groupBy("window_id").applyInPandasWithState(
        _window_partials_fn(n), out, state, "append", GroupStateTimeout.NoTimeout)
    return parts.withColumns({c: F.col(c).cast(kinds[c].dataType) for c in ("grp", "item")})


def _partials(spark: SparkSession, sf_dir: str, n: int, label: str) -> DataFrame:
    ev = stream_table(spark, sf_dir, "events")
    parts = window_partials_stream(ev, "event_id", "user_id", "event_id", "value", n)
    return _read_sink(spark, run_to_files(parts, label), parts.schema)


def stream_count_window_group_top(spark: SparkSession, sf_dir: str, n: int = 1000, k: int = 7) -> DataFrame:
    """Top-k groups of every complete window, from the streamed partials."""
    from quarry.operators.ordering import top_k_per_group

    parts = _partials(spark, sf_dir, n, "stream-group-top")
    top = top_k_per_group(parts, ["window_id"], [F.desc("n"), F.col("grp")], k)
    return top.select("window_id", "rank", F.col("grp").alias("user_id"), "n", F.col("value").alias("max_value"),
                      F.col("item").alias("top_item"))


def stream_cumulative_group_top(spark: SparkSession, sf_dir: str, n: int = 1000, k: int = 7, at: str | None = None) -> DataFrame:
    """Every window's top k so far, emitted by the stream itself."""
    ranks = cumulative_top_stream(stream_table(spark, sf_dir, "events"), "event_id", "user_id", "event_id", "value", n, k)
    out = run_to_files(ranks, "stream-cumulative", at=at)
    return _read_sink(spark, out, ranks.schema).select(
        "window_id", "rank", F.col("grp").alias("user_id"), "n", F.col("value").alias("max_value"), F.col("item").alias("top_item"))


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_word_count": stream_word_count,
    "stream_word_count_updates": stream_word_count_updates,
    "stream_top10": stream_top_words,
    "stream_total": stream_integer_total,
    "stream_count_window": stream_count_window_sum,
    "stream_count_window_log": stream_count_window_log,
    "stream_count_window_running_sum": stream_count_window_running_sum,
    "stream_count_window_word_top10": stream_count_window_word_top,
    "stream_count_window_bigram_top10": stream_count_window_bigram_top,
    "stream_count_window_group_top7": stream_count_window_group_top,
    "stream_cumulative_group_top7": stream_cumulative_group_top,
}

# Each stream's final result equals a batch query's; they share its oracle.
STREAM_ORACLE_OF = {
    "stream_word_count": "word_count",
    "stream_word_count_updates": "word_count",
    "stream_top10": "word_count_lower_top10",
    "stream_total": "integer_total",
    "stream_count_window": "count_window_sum",
    "stream_count_window_log": "count_window_sum",
    "stream_count_window_running_sum": "count_window_running_sum",
    "stream_count_window_word_top10": "count_window_word_top10",
    "stream_count_window_bigram_top10": "count_window_bigram_top10",
    "stream_count_window_group_top7": "count_window_group_top7",
    "stream_cumulative_group_top7": "cumulative_group_top7",
}
