"""Relational fixtures: delimited reads, header skip + HAVING, distinct pairs,
filtered join, count/max/argmax, fixed-width report (FIXTURES.md section 3)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import rows
from quarry.functions.scalars import address_prefix
from quarry.operators import relational
from quarry.operators.ordering import bucketed_ordinal
from quarry.sources.text import read_delimited

GAZ = ["USPS\tALAND", "IA\t150000000000", "IA\t100000000000", "RI\t3000000000"]


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_delimited_header_option_and_sum_having(spark, tmp_out):
    p = _write(os.path.join(tmp_out, "gaz.tsv"), GAZ)
    df = read_delimited(spark, p, "USPS string, ALAND long", header=True)
    got = rows(relational.grouped_sum_having(df, "USPS", "ALAND", 200000000000, decimal=None))
    assert got == [("IA", 250000000000)]


def test_header_skip_by_rank(spark, tmp_out):
    p = _write(os.path.join(tmp_out, "gaz2.tsv"), GAZ)
    df = read_delimited(spark, p, "USPS string, ALAND long")      # header read as data
    assert df.where(F.col("ALAND").isNull()).count() == 1           # unparsable field -> null
    ranked = df.withColumn("pos", F.monotonically_increasing_id())   # load order of one file
    body = relational.skip_first_rows(ranked, "pos", 1)
    got = rows(relational.grouped_sum_having(body, "USPS", "ALAND", 200000000000, decimal=None))
    assert got == [("IA", 250000000000)]


def test_skip_first_rows_matches_ordinal(spark):
    df = spark.createDataFrame([(k, k * 10) for k in (40, 7, 19, 3, 88)], "k long, v long")
    via_ordinal = bucketed_ordinal(df, "k", out="rn", bucket_width=4).where("rn >= 2").select("k", "v")
    assert rows(relational.skip_first_rows(df, "k", 2)) == rows(via_ordinal)


def test_network_trace_distinct_destinations(spark):
    trace = spark.createDataFrame([
        ("1.1.1.1.80", "2.2.2.2.53", "tcp"), ("1.1.1.1.80", "2.2.2.2.53", "tcp"),
        ("1.1.1.1.80", "3.3.3.3.53", "tcp"), ("1.1.1.1.80", "4.4.4.4.53", "udp")],
        "src string, dst string, protocol string")
    flows = (trace.where(F.col("protocol").rlike("^(?:tcp)$"))
             .select(address_prefix(F.col("src")).alias("source"), address_prefix(F.col("dst")).alias("dest")))
    got = [tuple(r) for r in relational.distinct_pairs_per_source(flows, "source", "dest").collect()]
    assert got == [("1.1.1.1", 2)]


def test_address_prefix(spark):
    df = spark.createDataFrame([("192.168.1.5.80",), ("ab",), ("abc",), ("10.0.0.1",)], "s string")
    got = [r[0] for r in df.select(address_prefix(F.col("s"))).collect()]
    # the dot is unescaped, so any three characters make a match; two do not
    assert got == ["192.168.1.5", None, "abc", "10.0.0.1"]


def test_firewall_join(spark):
    ips = spark.createDataFrame([("t1", "c1", "9.9.9.9"), ("t2", "c2", "9.9.9.9"), ("t3", "c3", "8.8.8.8")],
                                "time string, connectionID string, sourceIP string")
    raw = spark.createDataFrame([("c1", "Blocked"), ("c2", "Blocked"), ("c3", "Allowed")],
                                "connectionId string, actionTaken string")
    got = rows(relational.filtered_join_count(ips, raw, "connectionID", "connectionId",
                                              F.col("actionTaken") == "Blocked", "sourceIP"))
    assert got == [("9.9.9.9", 2)]


def test_count_max_argmax_and_report(spark):
    repos = spark.createDataFrame([("r1", "Java", 5, 0), ("r2", "Java", 9, 1), ("r3", "Go", 7, 2),
                                   ("r4", "Go", 7, 3)], "repo string, lang string, stars long, pos long")
    stats = relational.count_max_argmax(repos, "lang", "repo", "stars", "pos")
    got = rows(stats, "lang", "n", "top_item", "max_value")
    assert got == [("Go", 2, "r3", 7), ("Java", 2, "r2", 9)]     # tie on 7: earliest row wins
    lines = sorted(r.line for r in relational.fixed_width_report(stats, "lang").collect())
    assert lines[0] == f"{'Go':<15s} {2:<10d} {'r3':<50s} {'7':<10s}"      # integral stars print as integers


def test_count_max_argmax_fixture_exact(spark):
    repos = spark.createDataFrame([("r1", "Java", 5, 0), ("r2", "Java", 9, 1), ("r3", "Go", 7, 2)],
                                  "repo string, lang string, stars long, pos long")
    got = [(r.lang, r.n, r.top_item, r.max_value)
           for r in relational.count_max_argmax(repos, "lang", "repo", "stars", "pos").orderBy(F.desc("n")).collect()]
    assert got == [("Java", 2, "r2", 9), ("Go", 1, "r3", 7)]


def test_header_skip_with_a_null_smallest_key(spark):
    df = spark.createDataFrame([(None, "header"), (1, "a"), (2, "b")], "k long, v string")
    assert rows(relational.skip_first_rows(df, "k"), "k", "v") == [(1, "a"), (2, "b")]
    assert rows(relational.skip_first_rows(df, "k", 2), "k", "v") == [(2, "b")]


def test_distinct_counts_of_a_growing_store(spark, tmp_path):
    """Adding a period leaves the others' files alone; near the threshold counts are exact, far from it they are not looked up."""
    import random

    from quarry.operators import distinct

    rnd = random.Random(6)
    size = {None: 60, "near": 100, "below": 99, "far": 3000, "few": 3}
    data = [(s, rnd.choice([None, rnd.randrange(n)]) if s is None else rnd.randrange(n), p) for s, n in size.items() for p in (1, 2, 3)
            for _ in range(n * 3)]
    store = str(tmp_path / "store")

    def deliver(*periods):
        rows_ = [r for r in data if r[2] in periods]
        distinct.add_periods(spark.createDataFrame(rows_, "s string, d long, p int"), "s", "d", "p", store)

    def files():
        return {os.path.join(f, n): os.path.getmtime(os.path.join(f, n)) for f, _, names in os.walk(store) for n in names if "period=" in f}

    deliver(1, 2)
    before = files()
    deliver(3)
    assert before.items() <= files().items()
    deliver(3)                                              # the same delivery again
    want = {s: len({d for x, d, _ in data if x == s}) for s in size}
    got = {r["source"]: (r["reaches"], r["n"]) for r in distinct.reaching(spark, store, 100).collect()}
    assert got == {s: (n >= 100, n if s in ("near", "below") else None) for s, n in want.items()}
