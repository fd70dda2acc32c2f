"""Streams against their batch forms, and every registered query against its
DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from quarry.plans.catalog import QUERIES
from quarry.session import scratch_path
from quarry.sources.tables import TABLES, table_path
from quarry.streaming import jobs

OWN = {**QUERIES, **jobs.STREAM_QUERIES}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "∅" if v is None else str(v)


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["bigram", "n"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(OWN) <= set(entry.queries()) and set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _canon(cols, res.fetchall())


def test_streams_start_no_callback_server(spark):
    """Built-in sinks only: no stream may make PySpark start its Py4J callback
    server (a listening socket in this process), as foreachBatch would."""
    jobs.stream_word_count(spark, SF_SMALL).count()
    jobs.stream_top_words(spark, SF_SMALL).count()
    jobs.stream_count_window_sum(spark, SF_SMALL).count()
    assert spark.sparkContext._gateway._callback_server is None


def test_stream_window_state_is_released(spark):
    ev = jobs.stream_table(spark, SF_SMALL, "events")
    from pyspark.sql import functions as F
    w = jobs.count_window_stream(ev, F.col("event_id"), (F.col("value") * 100).cast("long"), 300)
    assert w.isStreaming
    out = jobs.run_to_files(w, "test-window")
    got = spark.read.parquet(out)
    assert got.count() == 3                      # 1000 events -> 3 complete windows of 300


@pytest.mark.parametrize("name", ["count_window_sum", "count_window_running_sum", "count_window_word_top10",
                                  "count_window_group_top7", "cumulative_group_top7"])
def test_many_buckets_match_oracle(spark, duck, monkeypatch, name):
    """Tiny bucket width: ordinals and running totals cross many buckets."""
    from quarry.plans import catalog
    monkeypatch.setattr(catalog, "ORDINAL_BUCKET_WIDTH", 7)
    df = catalog.QUERIES[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(cols, res.fetchall())


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_stream_text_sinks(spark, fmt):
    """The same append-mode stream written through the json and csv file sinks."""
    from pyspark.sql import functions as F
    ev = jobs.stream_table(spark, SF_SMALL, "events")
    w = jobs.count_window_stream(ev, F.col("event_id"), (F.col("value") * 100).cast("long"), 300)
    out = jobs.run_to_files(w, f"test-{fmt}", fmt=fmt)
    got = spark.read.schema("window_id long, cents long").format(fmt).load(out)
    assert sorted(r.window_id for r in got.collect()) == [0, 1, 2]


@pytest.fixture()
def one_file_a_batch(monkeypatch):
    monkeypatch.setattr(jobs, "BYTES_PER_TRIGGER", 1)


def test_streams_across_many_micro_batches(spark, tmp_path, one_file_a_batch):
    """Tables split into four files stream as four micro-batches (one file per
    trigger): window state, running counts and partials must carry across
    batches and give the batch results."""
    from quarry.plans import catalog
    src = str(tmp_path)
    for name, key in (("events", "event_id"), ("documents", "doc_id")):
        (spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartitionByRange(4, key)
         .sortWithinPartitions(key).write.parquet(f"{src}/{name}.parquet"))
    ev = jobs.stream_table(spark, src, "events")
    assert ev.isStreaming

    def same(a, b):
        return _canon(a.columns, [tuple(r) for r in a.collect()]) == _canon(b.columns, [tuple(r) for r in b.collect()])

    assert same(jobs.stream_count_window_sum(spark, src), catalog.QUERIES["count_window_sum"](spark, SF_SMALL))
    assert same(jobs.stream_count_window_group_top(spark, src),
                catalog.QUERIES["count_window_group_top7"](spark, SF_SMALL))
    assert same(jobs.stream_cumulative_group_top(spark, src),
                catalog.QUERIES["cumulative_group_top7"](spark, SF_SMALL))
    assert same(jobs.stream_count_window_running_sum(spark, src), catalog.QUERIES["count_window_running_sum"](spark, SF_SMALL))
    assert same(jobs.stream_count_window_word_top(spark, src), catalog.QUERIES["count_window_word_top10"](spark, SF_SMALL))
    assert same(jobs.stream_count_window_bigram_top(spark, src), catalog.QUERIES["count_window_bigram_top10"](spark, SF_SMALL))
    assert same(jobs.stream_word_count(spark, src), catalog.QUERIES["word_count"](spark, SF_SMALL))
    assert same(jobs.stream_top_words(spark, src), catalog.QUERIES["word_count_lower_top10"](spark, SF_SMALL))


def test_python_state_functions_need_no_installed_package(tmp_path):
    """Loaded by path from another directory (as a driver harness may do), the
    streams whose state runs in Python workers still work: their functions are
    shipped by value, so workers never import this package."""
    import os
    import subprocess
    import sys
    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", m.queries()["stream_word_count"](spark, {SF_SMALL!r}).count(),
      m.queries()["stream_count_window_group_top7"](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 27782 7" in res.stdout, res.stderr[-2000:]


def test_text_file_streams(spark, tmp_path, one_file_a_batch):
    """The text-file forms of J1-J3: a folder of three files streamed one file
    per micro-batch equals the batch answers."""
    lines = ["To be, or not to be.", "Be quick! To be sure.", "pay 12 and 30", "to be or 7"]
    for i, chunk in enumerate([lines[:2], lines[2:3], lines[3:]]):
        (tmp_path / f"part{i}.txt").write_text("\n".join(chunk) + "\n")
    src = str(tmp_path)
    wc = {r.word: r.n for r in jobs.stream_text_word_count(spark, src).collect()}
    assert wc["To"] == 2 and wc["be"] == 2 and wc["be,"] == 1 and sum(wc.values()) == 19
    top = [(r.word, r.n) for r in jobs.stream_text_top_words(spark, src, k=2).collect()]
    assert sorted(top, key=lambda t: (-t[1], t[0])) == [("be", 5), ("to", 4)]
    big = {r.bigram: r.n for r in jobs.stream_text_top_bigrams(spark, src, k=1).collect()}
    assert big == {"to be": 4}
    assert jobs.stream_text_integer_total(spark, src).first()["total"] == "49"


def test_count_windows_over_text_files(spark, tmp_path, one_file_a_batch):
    """J4, J6, J7, J8 on files: windows run over the files in path order, whatever
    micro-batch a file came in; the incomplete last window is not emitted."""
    from collections import Counter
    numbers = list(range(1, 58))
    for name, part in (("b", numbers[20:41]), ("a", numbers[:20]), ("c", numbers[41:])):
        (tmp_path / f"{name}.txt").write_text("\n".join(map(str, part)) + ("\n" if name != "c" else ""))
    src = str(tmp_path)
    sums = [sum(numbers[i:i + 10]) for i in range(0, 50, 10)]
    assert sorted(map(tuple, jobs.stream_text_window_sum(spark, src, n=10).collect())) == list(enumerate(sums))
    assert sorted(map(tuple, jobs.stream_text_window_sum(spark, src, n=10, running=True).collect())) == [
        (i, sum(sums[:i + 1])) for i in range(5)]
    words = tmp_path / "w"
    words.mkdir()
    lines = [f"x{i % 3} y. x{i % 2} x{i % 3} y" for i in range(23)]
    (words / "1.txt").write_bytes("\r\n".join(lines[:11]).encode())
    (words / "2.txt").write_text("\n".join(lines[11:]) + "\n")
    got = sorted(map(tuple, jobs.stream_text_window_top(spark, str(words), n=4, k=2).collect()))
    want = []
    for w in range(5):
        c = Counter(t.strip(".") for line in lines[4 * w:4 * w + 4] for t in line.split())
        want += [(w, t, n, r + 1) for r, (t, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:2])]
    assert got == sorted(want)
    big = jobs.stream_text_window_top(spark, str(words), n=4, k=1, bigrams=True).collect()
    assert len(big) == 5 and all(r["rank"] == 1 and " " in r["bigram"] for r in big)


def test_state_rows_do_not_grow_with_the_vocabulary(spark, tmp_path, one_file_a_batch):
    """Four micro-batches of ever new words: the widest state row stays one number."""
    for i in range(4):
        (tmp_path / f"{i}.txt").write_text("\n".join(f"w{j}" for j in range(200 * (i + 1))) + "\n")
    counts = jobs.running_counts(jobs.stream_text(spark, str(tmp_path)), "value")
    state = scratch_path(spark, "test-state")
    q = (counts.writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", state).trigger(availableNow=True).start())
    q.awaitTermination()
    rows_a_batch = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    assert len(rows_a_batch) == 4 and rows_a_batch == sorted(rows_a_batch) and rows_a_batch[-1] == 800   # files in any order
    values = spark.read.format("statestore").load(state)
    assert values.count() == 800
    assert values.select(F.length(F.to_json("value")).alias("l")).agg(F.max("l")).first()[0] < 20


def test_group_windows_of_any_type(spark, tmp_path, one_file_a_batch):
    """J9 partials with a text group and item."""
    rows_ = [(i, "äbc"[i % 3], f"item{i}", float(i * 7 % 11)) for i in range(47)]
    for f in range(3):
        spark.createDataFrame([r for r in rows_ if r[0] % 3 == f], "seq long, g string, i string, v double").coalesce(1).write.parquet(
            str(tmp_path / "t.parquet"), mode="append")
    stream = jobs.stream_table(spark, str(tmp_path), "t")
    parts = jobs.window_partials_stream(stream, "seq", "g", "i", "v", 10)
    got = sorted(map(tuple, jobs._read_sink(spark, jobs.run_to_files(parts, "test-groups"), parts.schema).collect()))
    want = []
    for w in range(4):
        for g in "äbc":
            mine = [r for r in rows_ if r[0] // 10 == w and r[1] == g]
            best = max(mine, key=lambda r: (r[3], -r[0]))
            want.append((w, g, len(mine), best[3], best[0], best[2]))
    assert got == sorted(want)
