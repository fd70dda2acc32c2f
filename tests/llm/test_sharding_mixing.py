from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from awkward import AWKWARD, docs
from pyspark.sql import functions as F

from quarry.llm import mixing, sharding
from quarry.llm.numbering import number_within


def brute_shard(key, weights):
    best = None
    for i, w in enumerate(weights):
        if w > 0:
            u = (int(hashlib.md5(f"{key}#{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            if best is None or w / -math.log(u) > best[0]:
                best = (w / -math.log(u), i)
    return best[1]


def test_shard_plan_by_hand(spark):
    got = sharding.shard_plan(docs(spark, AWKWARD), [1.0] * 4).collect()
    assert len(got) == len(AWKWARD)
    want = Counter()
    for i, t in AWKWARD:
        raw = (t or "").encode()
        key = "\\N" if i is None else str(i)
        want[(i, len(raw) + 1, zlib.crc32(raw), brute_shard(key, [1] * 4), brute_shard(key, [1] * 5))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_plan_empty(spark):
    assert sharding.shard_plan(docs(spark, AWKWARD).limit(0), [1.0] * 4).collect() == []


def test_growth_moves_rows_only_into_the_new_shard_and_weights_count(spark):
    ids = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    rows = sharding.shard_plan(ids, [1.0] * 16).collect()
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert all(r["grown_shard"] == 16 for r in moved)
    assert abs(len(moved) / len(rows) - 1 / 17) < 0.01
    got = Counter(r["shard"] for r in sharding.with_shard(ids, ["doc_id"], [1.0, 3.0, 0.0]).collect())
    assert set(got) == {0, 1} and abs(got[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(ids["text"], [0.0])


def test_numbers_of_a_hot_group_and_of_identical_rows(spark):
    hot = spark.range(30_000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end as g",
                                         "case when id % 3 = 0 then 0 else id end as k")
    by = defaultdict(list)
    for r in number_within(hot, "g", ["k"], "n").collect():
        by[r["g"]].append(r["n"])
    assert len(by["hot"]) == 10_000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_schedule_stays_within_a_block():
    rng = random.Random(3)
    for _ in range(60):
        weights = {f"s{i}": rng.random() ** 3 + 1e-3 for i in range(rng.randint(1, 30))}
        slots = mixing.quantised(weights, rng.choice([30, 100, 1000]))
        total, got = sum(slots.values()), dict.fromkeys(slots, 0)
        for t, (s, k, release, deadline, slot) in enumerate(mixing.one_period(slots)):
            assert slot == t and release <= t < deadline and k == got[s]
            got[s] += 1
            assert all(abs(got[x] - slots[x] * (t + 1) / total) < 1 for x in slots)
        assert got == slots
    assert mixing.quantised({}, 10) == {}


@pytest.mark.parametrize("sources", [20, 400, 5_000])
def test_many_sources_keep_their_weights(sources):
    """A hot source with half of the rows: every block lies in its window of the weights passed in, which is less than
    a block of deviation at any time, and those weights are the square roots to half a slot."""
    rows = {f"s{i}": 10_000 + i for i in range(1, sources)}
    rows["hot"] = sum(rows.values())
    roots = {s: n ** 0.5 for s, n in rows.items()}
    weights = mixing.quantised(roots)
    units, period = max(1000, 64 * sources), sum(weights.values())
    assert all(abs(n - roots[s] / sum(roots.values()) * units) <= 0.5 + 1e-6 for s, n in weights.items())
    assert abs(period - units) / units < 0.02
    got = Counter()
    for t, (s, k, _, _, slot) in enumerate(mixing.one_period(weights)):
        assert slot == t and k == got[s]
        got[s] += 1
        # block k is not there before its release and is by its deadline: |blocks - weight * time| < 1
        assert k * period < (t + 1) * weights[s] and t * weights[s] < (k + 1) * period
    assert got == weights


def test_more_than_a_thousand_sources(spark):
    d = docs(spark, [(i, "t") for i in range(3_000)], source=lambda k: f"s{k % 1_500}")
    rows = mixing.mix_plan(d, mixing.target_weights(d), block_rows=1).collect()
    assert len(rows) == 3_000 and sorted(r["position"] for r in rows) == list(range(3_000))


def test_places_with_clashing_names(spark):
    d = docs(spark, [(i, f"t{i}") for i in range(40)]).withColumns(
        {c: F.lit(c) for c in ("__at", "__src", "__id", "a.b", "at", "src", "doc", "position", "in_block", "i", "n", "rank", "slot")})
    w = mixing.target_weights(d)
    plan = {r["doc_id"]: (r["position"], r["in_block"]) for r in mixing.mix_plan(d, w).collect()}
    placed = mixing.with_place(d, w)
    assert {r["doc_id"]: (r["position"], r["in_block"]) for r in placed.collect()} == plan
    assert {r["a.b"] for r in placed.collect()} == {"a.b"}
    m = mixing.mixed(d, w)
    assert m.columns == d.columns and [plan[r["doc_id"]] for r in m.collect()] == sorted(plan.values())
    assert {(r["position"], r["__at"]) for r in m.collect()} == {("position", "__at")}


def check_plan(rows, n, period, block_rows):
    assert len(rows) == n
    blocks = {}
    for r in rows:
        assert blocks.setdefault((r["source"], r["block"]), r["position"]) == r["position"]
        assert r["release"] <= r["slot"] < r["deadline"]
    assert sorted(blocks.values()) == list(range(len(blocks)))
    per = defaultdict(list)
    for (s, b), p in sorted(blocks.items(), key=lambda x: (str(x[0][0]), x[0][1])):
        per[s].append((b, p))
    assert all([b for b, _ in v] == list(range(len(v))) and [p for _, p in v] == sorted(p for _, p in v) for v in per.values())
    full = Counter((r["source"], r["block"]) for r in rows)
    assert all(full[s, b] == block_rows for s, b in full if b < max(x for t, x in full if t == s))
    assert len({(r["position"], r["in_block"]) for r in rows}) == n


def test_mix_plan_keeps_all_rows_and_the_weights(spark):
    d = docs(spark, [(i, f"t{i}") for i in range(3_000)], source=lambda k: "hot" if k % 3 else f"s{k % 7}")
    weights = mixing.quantised(mixing.target_weights(d), 100)
    rows = mixing.mix_plan(d, weights, block_rows=4).collect()
    check_plan(rows, 3_000, 100, 4)
    slots, period = weights, sum(weights.values())
    have = Counter()
    for r in rows:
        have[r["source"]] = max(have[r["source"]], r["block"] + 1)
    order = sorted({(r["position"], r["source"]) for r in rows})
    got, out = Counter(), False
    for t, (_, s) in enumerate(order):
        got[s] += 1
        out = out or any(got[x] == have[x] for x in slots)
        if not out:
            assert all(abs(got[x] - slots[x] * (t + 1) / period) < 1 for x in slots)


def test_mix_plan_awkward(spark):
    d = docs(spark, AWKWARD, source=lambda k: None if k % 2 else "a")
    check_plan(mixing.mix_plan(d, mixing.target_weights(d), block_rows=2).collect(), len(AWKWARD), 10, 2)
    assert mixing.mix_plan(d.limit(0), mixing.target_weights(d.limit(0))).collect() == []
    with pytest.raises(ValueError, match="positive weight"):
        mixing.mix_plan(d, {"a": 1})
    with pytest.raises(ValueError, match="whole"):
        mixing.mix_plan(d, {"a": 0.5, None: 0.5})
    m = mixing.mixed(d, mixing.target_weights(d), block_rows=2)
    assert m.columns == d.columns
    key = lambda r: tuple(map(str, r))
    assert sorted(m.collect(), key=key) == sorted(d.collect(), key=key)


def test_mixed_rows_come_in_the_order_of_the_plan(spark):
    d = docs(spark, [(i, f"t{i}") for i in range(500)])
    w = mixing.target_weights(d)
    place = {r["doc_id"]: (r["position"], r["in_block"]) for r in mixing.mix_plan(d, w).collect()}
    got = [place[r["doc_id"]] for r in mixing.mixed(d, w).collect()]
    assert got == sorted(got) and len(got) == 500
