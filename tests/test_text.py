"""Hand-worked text fixtures (FIXTURES.md section 3, text_lines and java split)."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import text as T
from quarry.operators import text
from quarry.sources.text import document_lines, n_line_records, n_line_records_per_document

TEXT = "To be, or not to be.\nBe quick! To be sure."


def _docs(spark, t=TEXT):
    return spark.createDataFrame([(1, t)], "doc_id long, text string")


def test_whitespace_word_count(spark):
    got = dict(rows(text.word_count(_docs(spark))))
    assert got["To"] == 2
    assert sum(got.values()) == 11
    assert sorted(v for k, v in got.items() if k != "To") == [1] * 9


def test_token_total_and_second_round(spark):
    d = _docs(spark)
    assert text.token_total(d).first()["total"] == 11
    assert text.total_of_counts(text.word_count(d)).first()["total"] == 11


def test_lower_nonword_count(spark):
    got = dict(rows(text.lower_word_top(_docs(spark), k=100)))
    assert got == {"be": 4, "to": 3, "or": 1, "not": 1, "quick": 1, "sure": 1}


def test_lower_top_ties_by_word(spark):
    got = text.lower_word_top(_docs(spark), k=3).collect()
    assert [(r.word, r.n) for r in got] == [("be", 4), ("to", 3), ("not", 1)]


def test_script_tokens_full_match(spark):
    got = dict(rows(text.script_word_count(_docs(spark))))
    assert got == {"To": 2, "be": 2, "or": 1, "not": 1, "to": 1, "Be": 1}


def test_script_word_count_sorted_desc(spark):
    got = [r.n for r in text.script_word_count(_docs(spark)).collect()]
    assert got == sorted(got, reverse=True)


def test_line_bigrams(spark):
    got = dict(rows(text.line_bigram_count(document_lines(_docs(spark)))))
    assert got == {"to be": 3, "be or": 1, "or not": 1, "not to": 1, "be quick": 1,
                   "quick to": 1, "be sure": 1}


def test_reaggregate_second_round(spark):
    parts = spark.createDataFrame([("to be", 2), ("to be", 1), ("be or", 1)], "bigram string, n long")
    assert dict(rows(text.reaggregate(parts, "bigram"))) == {"to be": 3, "be or": 1}


def test_sentence_bigrams(spark):
    got = dict(rows(text.sentence_bigram_count(_docs(spark))))
    assert got == {"to be": 3, "be or": 1, "or not": 1, "not to": 1, "be quick": 1, "be sure": 1}


def test_representative_per_count(spark):
    counts = text.line_bigram_count(document_lines(_docs(spark)))
    got = [tuple(r) for r in text.representative_per_count(counts).collect()]
    assert got == [(1, "be or"), (3, "to be")]


def test_cross_line_bigram(spark):
    got = rows(text.cross_line_bigram_count(document_lines(_docs(spark))))
    assert got == [("be be", 1)]


def test_cross_line_skips_empty_lines_and_buckets(spark):
    t = "alpha beta\n\n!!!\ngamma\ndelta epsilon"
    lines = document_lines(_docs(spark, t))
    got = rows(text.cross_line_bigram_count(lines, bucket_width=2))
    assert got == [("beta gamma", 1), ("gamma delta", 1)]


def test_java_split_rules(spark):
    df = spark.createDataFrame([("",), ("   ",), (" a b ",), ("x\ty",)], "line string")
    got = [r[0] for r in df.select(T.java_whitespace_split(F.col("line"))).collect()]
    assert got == [[""], [], ["", "a", "b"], ["x", "y"]]


def test_java_split_count_ascending(spark):
    lines = spark.createDataFrame([(" a a",), ("a",), ("",)], "line string")
    got = [tuple(r) for r in text.java_split_word_count(lines).collect()]
    assert got == [("", 2), ("a", 3)]


def test_two_line_records(spark):
    lines = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c")],
                                  "doc_id long, line_no long, line string")
    assert rows(n_line_records(lines, 2)) == [(1, 1, "ab"), (1, 2, "c")]
    per_doc = n_line_records_per_document(_docs(spark, "a\nb\nc"), 2)
    assert rows(per_doc) == [(1, 1, "ab"), (1, 2, "c")]


def test_digit_tokens_total(spark):
    d = _docs(spark, "pay 12 and -3, x7 then 0042\n99999999999999999999")
    assert text.integer_total(d).first()["total"] == str(12 + 3 + 42 + 99999999999999999999)


def test_json_path_count(spark):
    ev = spark.createDataFrame([('{"k": 1}',), ('{"k": 1}',), ('{"k": 2}',), ("not json",), ("{}",)],
                               "props string")
    got = [tuple(r) for r in text.json_path_count(ev, "props", "$.k").collect()]
    assert got == [("2", 1), ("1", 2)]


def test_java_split_without_compat(spark):
    lines = spark.createDataFrame([(" a a",), ("a",), ("",)], "line string")
    assert [tuple(r) for r in text.java_split_word_count(lines, java_compat=False).collect()] == [("a", 3)]


@pytest.mark.parametrize("name", ["bigram_count", "bigram_representative", "bigram_sentence", "bigram_count_two_round"])
def test_bigram_counts_of_a_task_are_of_a_piece_of_a_split(spark, tmp_path, name):
    """With as many input splits as cores the rows are still dealt to smaller tasks: a task's counts are held in memory."""
    import re
    from collections import Counter

    from quarry.plans.catalog import QUERIES
    from quarry.sources.tables import PIECES, load
    docs = [(i, f"a b{i % 7} c\nd a b", "en" if i % 2 else None) for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    splits = load(spark, str(tmp_path), "documents").rdd.getNumPartitions()
    df = QUERIES[name](spark, str(tmp_path))
    tasks = re.search(r"RoundRobinPartitioning\((\d+)\)", df._jdf.queryExecution().executedPlan().toString())
    assert splits >= 4 and tasks and int(tasks.group(1)) == PIECES * splits
    want = Counter(f"{a} {b}" for _, t, _ in docs for ws in map(str.split, t.split("\n")) for a, b in zip(ws, ws[1:]))
    if name == "bigram_representative":
        assert dict(rows(df, "n", "bigram")) == {n: min(x for x in want if want[x] == n) for n in want.values()}
    else:
        assert dict(rows(df, "bigram", "n")) == want
