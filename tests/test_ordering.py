"""Ordinals, running sums, total-order ranks and the static key ranges."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions.scalars import static_range_bucket
from quarry.operators import ordering
from quarry.sources.text import first_two_tokens, key_value_on_tab


def test_bucketed_ordinal_matches_row_number(spark):
    random.seed(7)
    keys = random.sample(range(-5000, 50000), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = rows(ordering.bucketed_ordinal(df, "k", out="o", bucket_width=64), "k", "o")
    assert got == [(k, i) for i, k in enumerate(sorted(keys))]


def test_bucketed_running_sum_partitioned(spark):
    data = [("a", i, i) for i in range(1, 200)] + [("b", i, 2) for i in range(5)]
    df = spark.createDataFrame(data, "g string, k long, v long")
    got = rows(ordering.bucketed_running_sum(df, "k", "v", "run", partition_by=["g"], bucket_width=8),
               "g", "k", "run")
    exp, acc = [], {}
    for g, k, v in sorted(data):
        acc[g] = acc.get(g, 0) + v
        exp.append((g, k, acc[g]))
    assert got == exp


def test_global_rank_is_total_order(spark):
    random.seed(3)
    words = ["".join(random.choice("aZ09é") for _ in range(random.randint(1, 4))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(words)), "i long, w string")
    ranked = ordering.global_rank(df, ["w", "i"], partitions=7)
    got = [r.i for r in ranked.orderBy("rank").collect()]
    exp = [i for i, _ in sorted(enumerate(words), key=lambda t: (t[1].encode(), t[0]))]
    assert got == exp
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(1, 501))


def test_global_rank_descending(spark):
    df = spark.createDataFrame([("x", 3), ("y", 5), ("z", 3)], "s string, n long")
    got = rows(ordering.global_rank(df, [F.desc("n"), F.col("s")]), "rank", "s")
    assert got == [(1, "y"), (2, "x"), (3, "z")]


def test_static_range_buckets(spark):
    keys = ["6a", "7a", "Dz", "Ez", "bq", "cq", "zz", "-x"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = [r[0] for r in df.select(static_range_bucket(F.col("key"))).collect()]
    assert got == [0, 1, 1, 2, 5, 6, 9, 0]


def test_exact_ten_layout_puts_bucket_in_partition(spark):
    keys = ["6a", "7a", "Dz", "Ez", "bq", "cq", "zz", "-x", "Kq", "Qa", "io", "ou"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    laid = ordering.static_range_layout(df, "key", exact_ten=True)
    got = laid.select("bucket", F.spark_partition_id().alias("p")).collect()
    assert all(r.bucket == r.p for r in got)
    assert laid.rdd.getNumPartitions() == 10


def test_rank_within_static_range(spark):
    df = spark.createDataFrame([("b2",), ("a1",), ("c9",), ("A0",), ("dz",)], "key string")
    got = rows(ordering.rank_within_static_range(df, "key"), "bucket", "key", "rank_in_bucket")
    assert got == [(1, "A0", 1), (5, "a1", 1), (5, "b2", 2),
                   (6, "c9", 1), (6, "dz", 2)]


def test_key_value_readers(spark):
    lines = spark.createDataFrame([("k1\tv1\tx",), ("k2",), (" p  q r",)], "value string")
    assert rows(key_value_on_tab(lines)) == [(" p  q r", ""), ("k1", "v1\tx"), ("k2", "")]
    assert rows(first_two_tokens(lines)) == [("k1", "v1"), ("k2", None), ("p", "q")]


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(w, i, i % 3) for w in (0, 1) for i in range(10)], "w long, i long, v long")
    top = ordering.top_k_per_group(df, ["w"], [F.desc("v"), F.col("i")], 2)
    assert rows(top, "w", "i", "rank") == [(0, 2, 1), (0, 5, 2), (1, 2, 1), (1, 5, 2)]
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("w").orderBy(F.desc("v"), "i")))
    assert plain.where("r <= 2").count() == top.count()


def _key_sets():
    rnd = random.Random(21)
    return {"sparse 64-bit": [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(6000)],
            "clustered": [*range(1 << 40, (1 << 40) + 5000), *(rnd.randrange(-(1 << 62), 1 << 62) for _ in range(1000))],
            "two bands": [*range(3000), *range(1 << 60, (1 << 60) + 3000)],
            "dense": list(range(6000))}


@pytest.mark.parametrize("name", list(_key_sets()))
def test_sketch_buckets_are_even(spark, monkeypatch, name):
    """Whatever the keys' distribution: buckets within twice the mean, in the keys' order, exact results, one prefix step."""
    monkeypatch.setattr(ordering, "TARGET_ROWS", 100)
    keys = sorted(set(_key_sets()[name]))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    bucket, levels = ordering.key_buckets(df, "k")
    assert levels == 0
    held = {}
    for r in df.select("k", bucket.alias("b")).collect():
        held.setdefault(r["b"], []).append(r["k"])
    mean = len(keys) / len(held)
    assert 50 <= len(held) <= 70 and max(map(len, held.values())) <= 2 * mean
    assert [k for b in sorted(held) for k in sorted(held[b])] == keys
    assert rows(ordering.bucketed_ordinal(df, "k", out="o"), "k", "o") == [(k, i) for i, k in enumerate(keys)]


def test_shares_divided_between_their_cuts(spark, monkeypatch):
    """More buckets than shares: a share is divided evenly between its ends."""
    monkeypatch.setattr(ordering, "TARGET_ROWS", 10)
    monkeypatch.setattr(ordering, "SHARES", 16)
    keys = [k * k for k in range(-1500, 3000) if k]
    df = spark.createDataFrame([(k,) for k in sorted(set(keys))], "k long").repartition(3)
    assert df.select(ordering.key_buckets(df, "k")[0].alias("b")).distinct().count() > 150
    assert rows(ordering.bucketed_ordinal(df, "k", out="o"), "k", "o") == [(k, i) for i, k in enumerate(sorted(set(keys)))]


@pytest.mark.parametrize("width", ["auto", 3])
def test_null_keys_and_groups_are_kept(spark, monkeypatch, width):
    """As the plain window gives them: null keys first, a null group a group."""
    monkeypatch.setattr(ordering, "TARGET_ROWS", 3)
    rnd = random.Random(3)
    data = [(rnd.choice(["a", None]), k, rnd.choice([None, i * 7 % 5]), i) for i, k in enumerate([*range(20), None, None])]
    df = spark.createDataFrame(data, "g string, k long, v long, i long").repartition(3)
    key = lambda r: tuple(map(str, r))
    w = Window.partitionBy("g").orderBy("k", "i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cols = ("g", "k", "v", "i", "out")
    same = lambda got, want: sorted(rows_of(got, cols), key=key) == sorted(rows_of(want, cols), key=key)
    assert same(ordering.bucketed_running_sum(df, "k", "v", "out", ["g"], bucket_width=width, tie_breakers=["i"]),
                df.withColumn("out", F.coalesce(F.sum("v").over(upto), F.lit(0))))
    once = df.where("k is not null or i = 20")
    assert same(ordering.bucketed_running_max(once, "k", "v", "out", ["g"], bucket_width=width), once.withColumn("out", F.max("v").over(upto)))
    assert same(ordering.bucketed_lead(once, "k", "v", "out", ["g"], bucket_width=width), once.withColumn("out", F.lead("v").over(w)))
    plain = Window.orderBy("k", "i")
    assert same(ordering.bucketed_ordinal(df, "k", out="out", bucket_width=width, tie_breakers=["i"]),
                df.withColumn("out", F.row_number().over(plain) - 1))
    assert same(ordering.bucketed_lead(once, "k", "v", "out", bucket_width=width), once.withColumn("out", F.lead("v").over(plain)))
    none = df.where("k is null")
    assert sorted(r["ordinal"] for r in ordering.bucketed_ordinal(none, "k", bucket_width=width).collect()) == [0, 1]
    assert ordering.bucketed_ordinal(df.limit(0), "k", bucket_width=width).collect() == []


def rows_of(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_bucketed_max_and_next_partitioned(spark):
    random.seed(5)
    data = [(g, k, random.randint(0, 1000)) for g in ("a", "b") for k in random.sample(range(500), 120)]
    df = spark.createDataFrame(data, "g string, k long, v long")
    got_max = rows(ordering.bucketed_running_max(df, "k", "v", "m", partition_by=["g"], bucket_width=16),
                   "g", "k", "m")
    got_next = rows(ordering.bucketed_next(df, "k", "nx", partition_by=["g"], bucket_width=16), "g", "k", "nx")
    exp_max, exp_next = [], []
    for g in ("a", "b"):
        ks = sorted((k, v) for gg, k, v in data if gg == g)
        m = None
        for i, (k, v) in enumerate(ks):
            m = v if m is None else max(m, v)
            exp_max.append((g, k, m))
            exp_next.append((g, k, ks[i + 1][0] if i + 1 < len(ks) else None))
    assert got_max == sorted(exp_max)
    assert got_next == sorted(exp_next, key=lambda t: (t[0], t[1]))


def test_two_level_bucket_prefix(spark):
    """Tiny fan-out: the cross-bucket prefix itself crosses super-buckets."""
    random.seed(8)
    keys = random.sample(range(-3000, 9000), 2500)
    df = spark.createDataFrame([(k, k % 5) for k in keys], "k int, v long")
    ordering.TOP_FAN_OUT, saved = 64, ordering.TOP_FAN_OUT
    try:
        got = rows(ordering.bucketed_running_sum(df, "k", "v", "run", bucket_width=10, key_bits=15), "k", "run")
        got_max = rows(ordering.bucketed_running_max(df, "k", "v", "m", bucket_width=10, key_bits=15), "k", "m")
        got_ord = rows(ordering.bucketed_ordinal(df, "k", out="o"), "k", "o")
    finally:
        ordering.TOP_FAN_OUT = saved
    acc, mx, exp, exp_max = 0, None, [], []
    for k in sorted(keys):
        acc += k % 5
        mx = k % 5 if mx is None else max(mx, k % 5)
        exp.append((k, acc))
        exp_max.append((k, mx))
    assert got == exp and got_max == exp_max
    assert got_ord == [(k, i) for i, k in enumerate(sorted(keys))]


def test_sparse_64_bit_keys_leave_little_for_one_task(spark):
    """Random keys over the whole 64-bit range: ordinals, running max and lead are
    right, and the window without a partition sees few rows."""
    import random

    from quarry.operators import ordering as o
    rnd = random.Random(4)
    keys = sorted({rnd.randrange(-2 ** 63, 2 ** 63) for _ in range(3000)})
    df = spark.createDataFrame([(k, i * 7 % 1000) for i, k in enumerate(keys)], "k long, v long").repartition(4)
    got = {r["k"]: r["ordinal"] for r in o.bucketed_ordinal(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(keys)}
    lead = {r["k"]: r["nx"] for r in o.bucketed_next(df, "k", "nx").collect()}
    assert lead == dict(zip(keys, [*keys[1:], None]))
    high, want = -1, {}
    for i, k in enumerate(keys):
        high = max(high, i * 7 % 1000)
        want[k] = high
    assert {r["k"]: r["m"] for r in o.bucketed_running_max(df, "k", "v", "m").collect()} == want
    # 64-bit keys in buckets of 2^16, two levels of 2^16: at most 2^16 rows, whatever the keys
    for bits in range(0, 65):
        assert bits - 16 * o._levels(bits) <= 16
    assert o._levels(48) == 2 and o._levels(16) == 0
