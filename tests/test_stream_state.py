"""Streams that stop and go on, updates and commits that reach a table, and ranks and totals made by the stream itself."""

from __future__ import annotations

import os
import random

import pytest
from conftest import SF_SMALL
from quarry.streaming import cumulative, jobs, sinks

EVENTS = "event_id long, user_id long, value double"


def deliver(spark, path, rows, schema=EVENTS):
    """One more file of the table."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def events(n, seed=0, users=9):
    rnd = random.Random(seed)
    return [(i, None if rnd.random() < 0.1 else int(rnd.paretovariate(0.8)) % users, rnd.choice([None, 1.0, 2.0, rnd.random() * 9]))
            for i in range(n)]


@pytest.fixture()
def one_file_a_batch(monkeypatch):
    monkeypatch.setattr(jobs, "BYTES_PER_TRIGGER", 1)


@pytest.fixture(autouse=True)
def two_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_ranks(rows, n, k):
    """Every window's k groups with most rows so far, counted anew each time."""
    out = []
    for w in range(len(rows) // n):
        groups = {}
        for i, g, v in rows[:(w + 1) * n]:
            groups.setdefault(g, []).append((v is not None, v or 0.0, -i, v, i))
        ranked = sorted(groups.items(), key=lambda x: (-len(x[1]), x[0] is not None, x[0] if x[0] is not None else 0))
        for rank, (g, seen) in enumerate(ranked[:k], 1):
            out.append((w, rank, g, len(seen), *max(seen)[3:]))
    return sorted(out, key=str)


def got_ranks(df):
    return sorted((tuple(r) for r in df.select("window_id", "rank", "user_id", "n", "max_value", "top_item").collect()), key=str)


def test_cumulative_over_many_batches(spark, tmp_path, one_file_a_batch):
    """Rows in any order over three micro-batches: windows overtake each other and complete late."""
    rows = events(130)
    path, mixed = str(tmp_path / "events.parquet"), random.Random(1).sample(rows, len(rows))
    for i in range(3):
        deliver(spark, path, mixed[i * 50:(i + 1) * 50])
    got = jobs.stream_cumulative_group_top(spark, str(tmp_path), n=10, k=3)
    assert got_ranks(got) == plain_ranks(rows, 10, 3)


def test_cumulative_ranks_leave_while_the_stream_runs(spark, tmp_path):
    """Ranks of the windows that are complete are there after the first run; later ones follow, none twice."""
    rows = events(75, seed=3)
    path, at = str(tmp_path / "events.parquet"), str(tmp_path / "at")
    deliver(spark, path, rows[:34])
    first = jobs.stream_cumulative_group_top(spark, str(tmp_path), n=10, k=3, at=at)
    assert {r.window_id for r in first.collect()} == {0, 1, 2}
    deliver(spark, path, rows[34:])
    assert got_ranks(jobs.stream_cumulative_group_top(spark, str(tmp_path), n=10, k=3, at=at)) == plain_ranks(rows, 10, 3)


@pytest.mark.parametrize("kind,make", [("string", lambda g: None if g is None else f"g{g}"), ("double", lambda g: None if g is None else g / 2)])
def test_cumulative_keys_of_any_type(spark, tmp_path, kind, make):
    rows = [(i, make(g), v) for i, g, v in events(60, seed=4, users=12)]
    df = spark.createDataFrame(rows, f"event_id long, g {kind}, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    ev = jobs.stream_table(spark, str(tmp_path), "events")
    ranks = cumulative.cumulative_top_stream(ev, "event_id", "g", "event_id", "value", 20, 5, shards=3)
    got = spark.read.schema(ranks.schema).parquet(jobs.run_to_files(ranks, "test-cumulative"))
    got = sorted((tuple(r) for r in got.select("window_id", "rank", "grp", "n", "value", "item").collect()), key=str)
    assert got == plain_ranks([(i, g, v) for i, g, v in rows], 20, 5)


def test_window_groups_keep_null_groups(spark, tmp_path):
    """A null group is one of a window's groups, over two micro-batches of a window's rows in any order."""
    rows = [(i, g, 0.0 if v is None else v) for i, g, v in events(40, seed=8, users=3)]
    path, mixed = str(tmp_path / "events.parquet"), random.Random(2).sample(rows, len(rows))
    deliver(spark, path, mixed[:20])
    deliver(spark, path, mixed[20:])
    got = jobs.stream_count_window_group_top(spark, str(tmp_path), n=20, k=3)
    want = []
    for w in range(2):
        groups = {}
        for i, g, v in rows[w * 20:(w + 1) * 20]:
            groups.setdefault(g, []).append((v, -i))
        ranked = sorted(groups.items(), key=lambda x: (-len(x[1]), x[0] is not None, x[0] if x[0] is not None else 0))
        want += [(w, r, g, len(s), max(s)[0], -max(s)[1]) for r, (g, s) in enumerate(ranked[:3], 1)]
    assert got_ranks(got) == sorted(want, key=str)


def running(rows, n):
    out, total = [], 0
    for w in range(len(rows) // n):
        total += sum(v for _, v in rows[w * n:(w + 1) * n])
        out.append((w, total / 100))
    return out


@pytest.mark.parametrize("fan", [2, 1024])
def test_running_totals_out_of_order(spark, tmp_path, fan):
    """Three levels of buckets at a fan of two; files hold rows in any order."""
    rows = [(i, (i * 37) % 100) for i in range(28)]
    path = str(tmp_path / "events.parquet")
    mixed = random.Random(fan).sample(rows, len(rows))
    for i in range(2):
        deliver(spark, path, [(a, b / 100) for a, b in mixed[i * 14:(i + 1) * 14]], "event_id long, value double")
    got = jobs.stream_count_window_running_sum(spark, str(tmp_path), n=4, fan=fan)
    assert sorted((r.window_id, r.running_total) for r in got.collect()) == running(rows, 4)


def test_running_totals_wait_for_the_bucket_before(spark, tmp_path):
    """With a window missing, only the totals before it are there; it completes the others in a later run."""
    rows = [(i, i + 1) for i in range(40)]
    path, at = str(tmp_path / "events.parquet"), str(tmp_path / "at")
    late = [r for r in rows if 12 <= r[0] < 14]
    deliver(spark, path, [(a, b / 100) for a, b in rows if (a, b) not in late], "event_id long, value double")
    first = jobs.stream_count_window_running_sum(spark, str(tmp_path), n=4, at=at, fan=2)
    assert sorted((r.window_id, r.running_total) for r in first.collect()) == running(rows, 4)[:3]
    deliver(spark, path, [(a, b / 100) for a, b in late], "event_id long, value double")
    both = jobs.stream_count_window_running_sum(spark, str(tmp_path), n=4, at=at, fan=2)
    assert sorted((r.window_id, r.running_total) for r in both.collect()) == running(rows, 4)


def test_state_keys_see_one_bucket():
    """A key holds what overtook inside its bucket, and nothing once the bucket is full."""
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, v):
            self.exists, self.get = True, v

        def remove(self):
            self.exists, self.get = False, None

    state, fn = State(), jobs._running_total(4)
    out = [o for ids in ([7, 6], [5], [4]) for o in fn((1,), iter([pd.DataFrame({"window_id": ids, "cents": ids})]), state)]
    assert [x for o in out for x in zip(o["window_id"], o["cents"])] == [(4, 4), (5, 9), (6, 15), (7, 22)]
    assert not state.exists


def test_word_counts_go_on_after_a_stop(spark, tmp_path):
    path, at, schema = str(tmp_path / "documents.parquet"), str(tmp_path / "at"), "text string"
    deliver(spark, path, [("a b a",), ("c",)], schema)
    counts = lambda df: {r.word: r.n for r in df.collect()}
    assert counts(jobs.stream_word_count(spark, str(tmp_path), at=at)) == {"a": 2, "b": 1, "c": 1}
    deliver(spark, path, [("a d",)], schema)
    assert counts(jobs.stream_word_count(spark, str(tmp_path), at=at)) == {"a": 3, "b": 1, "c": 1, "d": 1}
    assert counts(jobs.stream_word_count(spark, str(tmp_path), at=at)) == {"a": 3, "b": 1, "c": 1, "d": 1}     # nothing new


def test_windows_go_on_after_a_stop(spark, tmp_path):
    """The window that is open at the stop completes after it; every window is there once."""
    rows = [(i, None, float(i)) for i in range(25)]
    path = str(tmp_path / "events.parquet")
    for form in (jobs.stream_count_window_sum, jobs.stream_count_window_log):
        at, src = str(tmp_path / f"at-{form.__name__}"), str(tmp_path / form.__name__)
        path = f"{src}/events.parquet"
        deliver(spark, path, rows[:13])
        assert sorted(r.window_id for r in form(spark, src, n=10, at=at).collect()) == [0]
        deliver(spark, path, rows[13:])
        want = [(0, 45.0), (1, 145.0)]
        assert sorted(tuple(r) for r in form(spark, src, n=10, at=at).collect()) == want
        assert sorted(tuple(r) for r in form(spark, src, n=10, at=at).collect()) == want


def test_one_update_per_key_and_batch(spark, tmp_path, one_file_a_batch):
    path, at = str(tmp_path / "documents.parquet"), str(tmp_path / "at")
    for text in ("a b a", "b", "c a"):
        deliver(spark, path, [(text,)], "text string")
    log = jobs.word_count_updates(spark, str(tmp_path), at=at)
    assert sorted((r.epoch, r.word, r.n) for r in log.collect()) == [(0, "a", 2), (0, "b", 1), (1, "b", 2), (2, "a", 3), (2, "c", 1)]


def test_updates_of_a_failed_batch_do_not_show(spark, tmp_path):
    """Files of a micro-batch that the query's commit log lacks are no rows, and a task that fails leaves no file."""
    path, at = str(tmp_path / "documents.parquet"), str(tmp_path / "at")
    deliver(spark, path, [("a",)], "text string")
    log = jobs.word_count_updates(spark, str(tmp_path), at=at)
    assert [tuple(r) for r in log.collect()] == [("a", 1, 0)]
    writer = sinks.UpdateLog(f"{at}/stream-word-updates/out", jobs.running_counts(spark.createDataFrame([("a",)], "word string"), "word").schema)
    row = spark.createDataFrame([("a", 99)], "word string, n long").first()
    writer.open(0, 1)
    writer.process(row)
    writer.close(None)                                      # written, but its micro-batch never commits
    writer.open(1, 1)
    writer.process(row)
    writer.close(RuntimeError("task fails"))
    folder = f"{at}/stream-word-updates/out/epoch=1"
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == ["part-00000.parquet"]
    again = sinks.read_update_log(spark, f"{at}/stream-word-updates/out", f"{at}/stream-word-updates/state", writer_schema(spark))
    assert [tuple(r) for r in again.collect()] == [("a", 1, 0)]
    deliver(spark, path, [("a a",)], "text string")         # the next run takes the same micro-batch number and replaces the file
    rows = jobs.word_count_updates(spark, str(tmp_path), at=at).collect()
    assert ("a", 99, 1) not in {tuple(r) for r in rows} and ("a", 3, 1) in {tuple(r) for r in rows}


def writer_schema(spark):
    return spark.createDataFrame([], "word string, n long").schema


def test_commit_log_abort_and_repeat(spark, tmp_path):
    schema = spark.createDataFrame([], "x long").schema
    writer = sinks._CommitLogWriter(str(tmp_path), schema)
    rows = spark.createDataFrame([(1,), (2,)], schema).collect()
    kept = [writer.write(iter(rows)), writer.write(iter([]))]
    writer.commit(kept, 0)
    lost = [writer.write(iter(rows)), None]
    writer.abort(lost, 1)
    assert sorted(r.x for r in sinks.read_commit_log(spark, str(tmp_path), schema).collect()) == [1, 2]
    writer.commit([writer.write(iter(rows))], 0)            # the same micro-batch again, after a restart
    assert sorted(r.x for r in sinks.read_commit_log(spark, str(tmp_path), schema).collect()) == [1, 2]
    assert len(os.listdir(tmp_path / "data")) == 1 + sum(f.endswith(".crc") for f in os.listdir(tmp_path / "data"))
    assert [m["batch"] for m in sinks.manifests(str(tmp_path))] == [0]

    def broken():
        yield rows[0]
        raise ValueError("source fails")
    with pytest.raises(ValueError):
        writer.write(broken())
    assert len(os.listdir(tmp_path / "data")) == 1


def test_no_callback_server(spark):
    jobs.stream_word_count_updates(spark, SF_SMALL).count()
    jobs.stream_count_window_log(spark, SF_SMALL).count()
    assert spark.sparkContext._gateway._callback_server is None
