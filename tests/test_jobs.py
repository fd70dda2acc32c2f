"""End-to-end jobs on raw input files (FIXTURES.md section 3 literal inputs)."""

from __future__ import annotations

import glob
import os
from collections import Counter

import pytest

from conftest import rows
from quarry.plans import jobs

TEXT = "To be, or not to be.\nBe quick! To be sure.\n"


def _file(tmp_out, name, content, mode="w"):
    path = os.path.join(tmp_out, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(content)
    return path


def _parts(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "**", "part-*"), recursive=True)):
        with open(f) as fh:
            out += [ln.rstrip("\n") for ln in fh]
    return out


def test_text_jobs(spark, tmp_out):
    src = _file(tmp_out, "in/text.txt", TEXT)
    wc = dict(rows(jobs.word_count_job(spark, src, os.path.join(tmp_out, "wc"))))
    assert wc["To"] == 2 and sum(wc.values()) == 11
    assert "To\t2" in _parts(os.path.join(tmp_out, "wc"))
    assert jobs.word_total_job(spark, src).first()["total"] == 11
    big = dict((b, n) for n, b in rows(jobs.bigram_frequency_job(spark, src)))
    assert big["to be"] == 3 and big["quick to"] == 1
    rep = [tuple(r) for r in jobs.bigram_frequency_job(spark, src, representative=True).collect()]
    assert rep == [(1, "be or"), (3, "to be")]
    assert rows(jobs.cross_line_bigram_job(spark, src)) == [("be be", 1)]
    assert dict(rows(jobs.script_word_count_job(spark, src))) == {"To": 2, "be": 2, "or": 1, "not": 1,
                                                                  "to": 1, "Be": 1}
    assert jobs.integer_total_job(spark, _file(tmp_out, "in2/n.txt", "a 12\n-3 b7 40\n")).first()[0] == "55"


def test_sorted_word_count_tuples(spark, tmp_out):
    src = _file(tmp_out, "in/j.txt", " a a\na\n")
    out = os.path.join(tmp_out, "tuples")
    jobs.sorted_word_count_job(spark, src, out)
    assert sorted(_parts(out)) == ["(1,)", "(3,a)"]        # " a a" gives one leading empty token


def test_records_and_hashtags(spark, tmp_out):
    d = os.path.join(tmp_out, "rec")
    _file(tmp_out, "rec/a.txt", "a\nb\nc\n")
    _file(tmp_out, "rec/b.txt", "d\ne\n")
    got = rows(jobs.two_line_records_job(spark, d), "rec_no", "record")
    assert got == [(1, "ab"), (1, "de"), (2, "c")]
    tweets = ('{\n "entities": {"hashtags": [{"text": "a"}, {"text": "b"}]}\n}\n'
              '{\n "entities": {"hashtags": [{"text": "a"}]}\n}\n'
              '{\n "entities": {"hashtags": [{"text": \n}\n'
              '{\n "id": 4\n}\n')
    src = _file(tmp_out, "tw/t.json", tweets)
    assert [tuple(r) for r in jobs.hashtag_count_job(spark, src).collect()] == [("b", 1), ("a", 2)]
    assert [r.tag for r in jobs.hashtag_count_job(spark, src, quoted=True).collect()] == ['"b"', '"a"']


def test_relational_jobs(spark, tmp_out):
    gaz = _file(tmp_out, "gaz/g.tsv", "USPS\tGEOID\tPOP10\tHU10\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG\n"
                "IA\t1\t1\t1\t150000000000\t0\t0\t0\t0\t0\nIA\t2\t1\t1\t100000000000\t0\t0\t0\t0\t0\n"
                "RI\t3\t1\t1\t3000000000\t0\t0\t0\t0\t0\n")
    assert rows(jobs.land_area_job(spark, gaz)) == [("IA", 250000000000)]
    trace = _file(tmp_out, "nt/t.txt", "t1 x 1.1.1.1.80 > 2.2.2.2.53 tcp d\nt2 x 1.1.1.1.80 > 2.2.2.2.53 tcp d\n"
                  "t3 x 1.1.1.1.80 > 3.3.3.3.53 tcp d\nt4 x 1.1.1.1.80 > 4.4.4.4.53 udp d\n")
    assert rows(jobs.distinct_destinations_job(spark, trace)) == [("1.1.1.1", 2)]
    ipt = _file(tmp_out, "fw/ip.txt", "t1 c1 9.9.9.9 > 1.1.1.1 tcp d\nt2 c2 9.9.9.9 > 1.1.1.1 tcp d\n"
                "t3 c3 8.8.8.8 > 1.1.1.1 tcp d\n")
    raw = _file(tmp_out, "fw/raw.txt", "c1 Blocked\nc2 Blocked\nc3 Allowed\n")
    assert rows(jobs.firewall_job(spark, ipt, raw)) == [("9.9.9.9", 2)]
    prices = "".join(f"A,2010-01-{i + 1:02d},10.0\n" for i in range(10)) + "A,2010-02-01,100.0\nB,2011-01-01,5\n"
    out = os.path.join(tmp_out, "outliers")
    got = rows(jobs.stock_outlier_job(spark, _file(tmp_out, "st/p.csv", prices), out), "ticker", "price", "label")
    assert got == [("A", 100.0, "high")]
    assert _parts(out) == ["(A,2010,2010-02-01,100.0,high)"]


def _repo_line(repo, lang, stars):
    return ",".join([repo, lang] + ["x"] * 10 + [str(stars)]) + "\n"


def test_language_jobs(spark, tmp_out):
    src = _file(tmp_out, "gh/r.csv", _repo_line("r1", "Java", 5) + _repo_line("r2", "Java", 9)
                + _repo_line("r3", "Go", 7))
    lines = [r.line for r in jobs.language_report_job(spark, src).collect()]
    assert lines == [f"{'Java':<15s} {2:<10d} {'r2':<50s} {'9':<10s}", f"{'Go':<15s} {1:<10d} {'r3':<50s} {'7':<10s}"]
    cum = _file(tmp_out, "gh2/r.csv", _repo_line("a", "g1", 5) + _repo_line("b", "g2", 1)
                + _repo_line("c", "g1", 9) + _repo_line("d", "g1", 2))
    got = rows(jobs.language_window_top_job(spark, cum, n=2, k=7, cumulative=True),
               "window_id", "language", "n", "top_item", "max_value")
    assert got == [(0, "g1", 1, "a", 5), (0, "g2", 1, "b", 1), (1, "g1", 3, "c", 9), (1, "g2", 1, "b", 1)]


def test_graph_jobs(spark, tmp_out):
    edges = _file(tmp_out, "g/e.tsv", "1\t2\n2\t3\n1\t3\n3\t4\n4\t4\n2\t4\n")
    assert jobs.triangle_job(spark, edges).first()[0] == 2
    cites = _file(tmp_out, "c/p.txt", "1 2\n1 3\n2 5\n3 1\n")
    sets, hops = jobs.citation_jobs(spark, cites)
    assert rows(sets) == [(1, 2, 2), (1, 3, 2), (2, 5, 1)]
    assert rows(hops) == [(1, 5), (3, 2)]


def test_sort_jobs(spark, tmp_out):
    kv = _file(tmp_out, "kv/k.txt", "".join(f"{k}\tv{k}\n" for k in (9, 10, 1, 100, 2, 55, 3)))
    out = os.path.join(tmp_out, "sorted")
    jobs.total_order_sort_job(spark, kv, out, n=3)
    assert [ln.split("\t")[0] for ln in _parts(out)] == ["1", "10", "100", "2", "3", "55", "9"]
    tp = _file(tmp_out, "tp/t.txt", "zz 1\n6a 2\nDz 3\n7a 4 extra\nbq\n")
    ten = os.path.join(tmp_out, "ten")
    jobs.static_range_sort_job(spark, tp, ten, exact_ten=True)
    files = {int(os.path.basename(f)[5:10]): open(f).read().split("\n")
             for f in glob.glob(os.path.join(ten, "part-*"))}
    assert files[1][:2] == ["7a\t4", "Dz\t3"] and files[9][0] == "zz\t1" and files[5][0] == "bq\t"


def test_window_jobs(spark, tmp_out):
    ints = _file(tmp_out, "w/i.txt", "".join(f"{i}\n" for i in range(1, 8)))
    assert rows(jobs.window_sum_job(spark, ints, n=3)) == [(0, 6.0), (1, 15.0)]
    assert rows(jobs.window_sum_job(spark, ints, n=3, running=True)) == [(0, 6.0), (1, 21.0)]
    src = _file(tmp_out, "w2/t.txt", TEXT * 2)
    top = rows(jobs.window_top_job(spark, src, n=2, k=1), "window_id", "item", "n")
    assert top == [(0, "be", 3), (1, "be", 3)]
    big = rows(jobs.window_top_job(spark, src, n=4, k=1, bigrams=True), "window_id", "item", "n")
    assert big == [(0, "to be", 6)]


def test_file_xor(spark, tmp_out):
    path = _file(tmp_out, "bin/b.dat", b"zzabcq", mode="wb")
    got = jobs.file_xor_job(spark, path, 2, 3).first()
    assert got.checksum == 96


def test_representative_bigram_output_shape(spark, tmp_out):
    """Golden output shape: one `frequency<TAB>word word` line per distinct
    frequency, frequencies unique and ascending from 1."""
    import re
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    src = os.path.join(tmp_out, "corpus")
    docs.select("text").write.text(src)
    out = os.path.join(tmp_out, "golden")
    jobs.bigram_frequency_job(spark, src, out, representative=True)
    lines = _parts(out)
    assert lines and all(re.fullmatch(r"\d+\t[a-z0-9]+ [a-z0-9]+", ln) for ln in lines)
    freqs = [int(ln.split("\t")[0]) for ln in lines]
    assert freqs[0] == 1 and freqs == sorted(set(freqs))


def test_bigram_second_round(spark, tmp_out):
    d = os.path.join(tmp_out, "round1")
    _file(tmp_out, "round1/part-0", "to be\t2\nbe or\t1\n")
    _file(tmp_out, "round1/part-1", "to be\t1\nnot to\t4\nbroken line\n")
    assert rows(jobs.bigram_reaggregate_job(spark, d)) == [("be or", 1), ("not to", 4), ("to be", 3)]


def test_malformed_objects_are_kept_and_counted(spark, tmp_out):
    src, bad = os.path.join(tmp_out, "t.json"), os.path.join(tmp_out, "bad")
    with open(src, "w") as f:
        f.write('{\n "entities": {"hashtags": [{"text": "a"}, {"text": "b"}]}\n},\n{\n broken one\n},\n'
                '{\n "entities": {"hashtags": [{"text": "a"}]}\n}\n{\n broken two\n}\n')
    counts, kept = jobs.hashtag_count_job(spark, src, bad=bad)
    assert [tuple(r) for r in counts.collect()] == [("b", 1), ("a", 2)]
    assert sorted(r.record for r in kept.bad.collect()) == ["{\n broken one\n}", "{\n broken two\n}"]
    assert (kept.objects, kept.malformed, kept.good.count()) == (4, 2, 2)
    with open(src, "w") as f:
        f.write("nothing here\n")
    counts, kept = jobs.hashtag_count_job(spark, src, bad=bad + "2")
    assert counts.collect() == [] and (kept.objects, kept.malformed, kept.bad.count()) == (0, 0, 0)


@pytest.mark.parametrize("ends", ["\n", "\r\n", "\r", None])
def test_text_streams_number_lines_as_the_reader_does(spark, tmp_out, ends):
    """Lone CRs, CR LF, LF, and no final line end: windows of a text stream are those of the numbered batch lines."""
    for name, k in (("a.txt", 5), ("b.txt", 5), ("c.txt", 3)):
        with open(os.path.join(tmp_out, name), "w", newline="") as f:
            parts = [f"{name[0]} {i % 2} x{i}" for i in range(k)]
            mixed = "".join(p + ("\r", "\n", "\r\n")[i % 3] for i, p in enumerate(parts))
            f.write(mixed.rstrip() if ends is None else ends.join(parts))
    from quarry.sources.text import text_lines_numbered
    from quarry.streaming import jobs as streams

    want = {}
    for r in text_lines_numbered(spark, tmp_out)[0].collect():
        want.setdefault(r["ord"] // 2, []).extend(r["value"].split())
    full = {w: Counter(v) for w, v in want.items() if w < 13 // 2}
    got = streams.stream_text_window_top(spark, tmp_out, n=2, k=10).collect()
    assert {w: {r["word"]: r["n"] for r in got if r["window_id"] == w} for w in {r["window_id"] for r in got}} == full
