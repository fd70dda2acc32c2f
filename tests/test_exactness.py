"""Inputs on which nothing may be lost or miscounted: long numbers, CRLF and
comma-closed objects, files in many splits, line terminators in a full match,
long sums, unreadable sinks, and who deletes scratch folders."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import text as T
from quarry.operators import text
from quarry.plans import jobs
from quarry.session import checkpoint_dir, release_scratch, scratch_path, scratch_scope, write_scratch
from quarry.sources.text import read_multiline_json_objects, text_lines_numbered
from quarry.streaming import jobs as streaming
from test_session import _Session


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("tokens", [
    ["12", "9" * 39, "5"], ["9" * 38, "9" * 38], ["0", "000"], ["7" * 400, "1" + "0" * 399, "0" * 50 + "3"], [], ["1" + "0" * 18, "9" * 18],
])
def test_integer_total_of_tokens_of_any_length(spark, tmp_path, tokens):
    texts = ["x -" + " y,".join(tokens) + " z1 1z", "", None, " ".join(tokens)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    want = str(2 * sum(map(int, tokens)))
    assert text.integer_total(df).first()["total"] == want
    (tmp_path / "a.txt").write_text("\n".join(t for t in texts if t is not None))
    assert streaming.stream_text_integer_total(spark, str(tmp_path)).first()["total"] == want


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
@pytest.mark.parametrize("close", ["}", "},", "} , "])
def test_objects_of_any_line_end_and_closing_line(spark, tmp_path, small_splits, eol, close):
    for f in range(3):
        objs = [f'{{{eol}  "k": "v{f}-{i}",{eol}  "n": {{ "a": 1 }}{eol}{close}' for i in range(40)]
        objs[7] = f'{{{eol}  "k": broken{eol}{close}'
        (tmp_path / f"{f}.json").write_bytes(("[" + eol + eol.join(objs) + eol + "]" + eol).encode())
    got = read_multiline_json_objects(spark, str(tmp_path), "k string").select("j.k", "_corrupt").collect()
    assert sorted(r["k"] for r in got if not r["_corrupt"]) == sorted(f"v{f}-{i}" for f in range(3) for i in range(40) if i != 7)
    assert sum(r["_corrupt"] for r in got) == 3


def test_line_numbers_of_files_in_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = {}
    for name, n in (("b.txt", 101), ("a.txt", 150), ("c.txt", 1), ("d.txt", 33)):
        lines = [f"{name}-{i}-" + "x" * rng.randint(0, 60) for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want[name] = lines
    lines, blocks = text_lines_numbered(spark, str(tmp_path))
    got = lines.collect()
    assert {(os.path.basename(r["file"]), r["line_no"], r["value"]) for r in got} == {
        (f, i, v) for f, ls in want.items() for i, v in enumerate(ls)}
    order = [v for f in sorted(want) for v in want[f]]
    assert [r["value"] for r in sorted(got, key=lambda r: r["ord"])] == order
    assert sorted(r["ord"] for r in got) == list(range(285))
    assert blocks.count() > 10 and blocks.agg(F.sum("n")).first()[0] == 285
    records = jobs.two_line_records_job(spark, str(tmp_path)).collect()
    assert {(os.path.basename(r["file"]), r["rec_no"], r["record"]) for r in records} == {
        (f, i // 2 + 1, "".join(ls[i:i + 2])) for f, ls in want.items() for i in range(0, len(ls), 2)}


def test_full_match_does_not_stop_before_a_line_end(spark):
    df = spark.createDataFrame([("abc",), ("abc\r",), ("abc\n",), ("a b",), ("",)], "text string")
    assert rows(df.where(T.full_match(F.col("text"), r"\w+"))) == [("abc",)]
    assert rows(text.script_word_count(df)) == [("a", 1), ("abc", 2), ("b", 1)]


def test_long_sums_stay_long(spark, tmp_path):
    header = "USPS\tGEOID\tPOP10\tHU10\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG\n"
    body = "".join(f"{s}\t1\t1\t1\t{a}\t1\t1.0\t1.0\t1.0\t1.0\n" for s, a in (("AK", 9007199254740990), ("AK", 3), ("AL", 5)))
    (tmp_path / "in.tsv").write_text(header + body)
    got = jobs.land_area_job(spark, str(tmp_path / "in.tsv"), out=str(tmp_path / "out"))
    assert got.dtypes == [("USPS", "string"), ("land", "bigint")]
    assert [tuple(r) for r in got.collect()] == [("AK", 9007199254740993)]
    written = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert written == "AK\t9007199254740993\n"


def test_an_unreadable_sink_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        streaming._read_sink(spark, str(tmp_path / "missing"), "word string, n long").collect()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.txt").write_text("")
    assert streaming.stream_text_word_count(spark, str(tmp_path / "in")).collect() == []


def test_scratch_folders_have_an_owner_that_deletes_them(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    count = lambda: len([d for d in os.listdir(base) if d.startswith("quarry-test-")])
    before = count()
    outer = write_scratch(spark.range(3).toDF("a"), "test-outer")
    with scratch_scope(spark):
        assert write_scratch(spark.range(5).toDF("a"), "test-inner").count() == 5
        assert count() == before + 2
    assert count() == before + 1 and outer.count() == 3
    path = scratch_path(spark, "test-single")
    spark.range(1).write.parquet(path)
    assert release_scratch(spark, {path}) == 1 and count() == before + 1
    with pytest.raises(ValueError), scratch_scope(spark):
        write_scratch(spark.range(1).toDF("a"), "test-failed")
        raise ValueError
    assert count() == before + 1


@pytest.mark.parametrize("set_before,named,fine", [
    ("file:/tmp/private/1", None, False), ("/tmp/private", "hdfs://nn/shared", False), ("file:/shared/x", "file:///shared", True),
    ("hdfs://nn/shared/1", None, True), ("file:/shared-not/x", "/shared-no", False),
])
def test_a_local_folder_set_before_is_refused_on_a_cluster(set_before, named, fine):
    for master in ("yarn", "local-cluster[3,2,1024]"):
        s = _Session(master, {"spark.checkpoint.dir": named} if named else {})
        s.sparkContext.dir = set_before
        if fine:
            assert checkpoint_dir(s) == set_before
        else:
            with pytest.raises(RuntimeError):
                checkpoint_dir(s)
    s = _Session("local[2]", {})
    s.sparkContext.dir = set_before
    assert checkpoint_dir(s) == set_before
