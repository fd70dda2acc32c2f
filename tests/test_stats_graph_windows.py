"""Outliers, byte XOR, graph operators and count windows (FIXTURES.md section 3)."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from conftest import rows
from graph_lists import neighbour_lists, triangle_count_by_lists
from quarry.operators import graph, stats, windows
from quarry.operators.ordering import bucketed_ordinal


def _prices(spark, extra_high=True):
    data = [("A", 2010, i, 10.0) for i in range(10)]
    if extra_high:
        data.append(("A", 2010, 10, 100.0))
    data += [("B", 2011, i, float(i)) for i in range(10)]
    return spark.createDataFrame(data, "ticker string, year long, id long, price double")


def test_three_sigma_high(spark):
    got = rows(stats.sigma_outliers(_prices(spark), ["ticker", "year"], "price"), "ticker", "price", "label")
    assert got == [("A", 100.0, "high")]
    win = rows(stats.sigma_outliers_window(_prices(spark), ["ticker", "year"], "price"),
               "ticker", "price", "label")
    assert win == got


def test_ten_rows_never_outlier(spark):
    assert stats.sigma_outliers(_prices(spark, extra_high=False), ["ticker", "year"], "price").count() == 0


def test_group_stats_population(spark):
    s = stats.group_stats(_prices(spark), ["ticker"], "price").where("ticker = 'A'").first()
    assert abs(s.mean - 18.1818) < 1e-3 and abs(s.std - 25.8732) < 1e-3


def test_xor_checksum(spark):
    df = spark.createDataFrame([(1, bytearray(b"abc")), (2, bytearray(b"\xff")), (3, bytearray(b"")),
                                (4, bytearray(bytes(range(256)) * 3 + b"\x07"))], "id long, b binary")
    got = dict(rows(stats.xor_checksum(df, "id", F.col("b"))))
    assert got == {1: 96, 2: -1, 3: 0, 4: 7}


def test_xor_grouped(spark):
    df = spark.createDataFrame([(1, 0x61), (1, 0x62), (1, 0x63), (2, 0xFF)], "g long, b int")
    assert dict(rows(stats.xor_checksum_grouped(df, "g", "b"))) == {1: 96, 2: -1}


EDGES = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 4), (2, 4)]


def test_triangles_three_plans(spark):
    e = spark.createDataFrame(EDGES + [(2, 1)], "src long, dst long")
    assert graph.triangle_count(e).first()[0] == 2
    assert graph.triangle_count_by_id(e).first()[0] == 2
    assert triangle_count_by_lists(e).first()[0] == 2


def test_triangles_on_test_table_agree(spark):
    from quarry.plans.catalog import _event_edges
    e = _event_edges(spark, "/root/testdata/sf0.001")
    assert graph.triangle_count(e).first()[0] == triangle_count_by_lists(e).first()[0] == 1681


def test_neighbour_sets_and_two_hop(spark):
    p = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (3, 1)], "src long, dst long")
    assert rows(graph.neighbour_sets(p)) == [(1, 2, 2), (1, 3, 2), (2, 5, 1)]
    assert rows(neighbour_lists(p)) == [(1, [2, 3]), (2, [5])]
    assert rows(graph.two_hop_links(p)) == [(1, 5), (3, 2)]


def _ints(spark, n=7):
    return spark.createDataFrame([(i - 1, float(i)) for i in range(1, n + 1)], "ord long, value double")


def test_count_window_sums(spark):
    assert rows(windows.count_window_sum(_ints(spark), "ord", "value", 3)) == [(0, 6.0), (1, 15.0)]
    assert rows(windows.count_window_running_sum(_ints(spark), "ord", "value", 3, bucket_width=1)) == \
        [(0, 6.0), (1, 21.0)]


def test_count_window_top_k_drops_incomplete(spark):
    items = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "c")], "window_id long, item string")
    ok = spark.createDataFrame([(0,)], "window_id long")
    got = rows(windows.count_window_top_k(items, ok, "item", 1), "window_id", "item", "n", "rank")
    assert got == [(0, "a", 2, 1)]


def _repo_rows(spark):
    return spark.createDataFrame([(0, "g1", "a", 5.0), (1, "g2", "b", 1.0), (2, "g1", "c", 9.0),
                                  (3, "g1", "d", 2.0), (4, "g3", "e", 1.0)],
                                 "ord long, grp string, item string, value double")


def test_count_window_group_top(spark):
    got = rows(windows.count_window_group_top(_repo_rows(spark), "ord", "grp", "item", "value", 2, 7),
               "window_id", "grp", "n", "top_item", "max_value", "rank")
    assert got == [(0, "g1", 1, "a", 5.0, 1), (0, "g2", 1, "b", 1.0, 2), (1, "g1", 2, "c", 9.0, 1)]


def test_cumulative_group_top(spark):
    got = rows(windows.cumulative_group_top(_repo_rows(spark), "ord", "grp", "item", "value", 2, 7),
               "window_id", "grp", "n", "top_item", "max_value")
    assert got == [(0, "g1", 1, "a", 5.0), (0, "g2", 1, "b", 1.0),
                   (1, "g1", 3, "c", 9.0), (1, "g2", 1, "b", 1.0)]


def test_event_ordinal_is_dense(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    o = bucketed_ordinal(ev, "event_id", out="ord", bucket_width=100)
    assert o.where(F.col("ord") != F.col("event_id")).count() == 0


def test_outliers_of_null_groups(spark):
    """The join form finds what the window form finds: a null ticker, or year, is a group."""
    data = [(t, y, 1.0 + 100 * (i == 20)) for t in (None, "a") for y in (1, None) for i in range(21)]
    df = spark.createDataFrame(data, "ticker string, year int, price double")
    both = [sorted(map(str, f(df, ["ticker", "year"], "price").collect())) for f in (stats.sigma_outliers, stats.sigma_outliers_window)]
    assert both[0] == both[1] and len(both[0]) == 4


def test_cumulative_top_keeps_null_groups(spark):
    data = [(i, None if i % 3 == 0 else f"g{i % 5}", float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(data, "ord long, g string, v double")
    got = windows.cumulative_group_top(df, "ord", "g", "ord", "v", 10, 2, F.lit(60)).collect()
    want = []
    for w in range(6):
        seen = {}
        for i, g, v in data[:(w + 1) * 10]:
            seen.setdefault(g, []).append((v, -i))
        top = sorted(seen.items(), key=lambda x: (-len(x[1]), x[0] is not None, x[0] or ""))[:2]
        want += [(w, r, g, len(s), max(s)[0], -max(s)[1]) for r, (g, s) in enumerate(top, 1)]
    assert sorted(map(str, ((r["window_id"], r["rank"], r["g"], r["n"], r["max_value"], r["top_item"]) for r in got))) == sorted(map(str, want))


def test_two_hop_links_through_hubs(spark):
    """A hub with a third of all edges in both directions, a second hub sharing its ends, and light nodes: as without
    bitmaps; a hub's links are never rows before they are distinct."""
    import random

    rnd = random.Random(5)
    edges = [(f"a{i}", "hub") for i in range(150)] + [("hub", f"c{i}") for i in range(150)] + [(f"a{i}", "hub2") for i in range(0, 150, 2)]
    edges += [("hub2", f"c{i}") for i in range(0, 150, 3)] + [("hub2", f"a{i}") for i in range(20)] + [("hub", "hub2"), ("hub2", "hub"), (None, "hub")]
    edges += [(f"n{rnd.randrange(40)}", rnd.choice([f"n{rnd.randrange(40)}", "hub"])) for _ in range(300)]
    df = spark.createDataFrame(edges, "src string, dst string").repartition(4)
    outs = {}
    for a, b in edges:
        outs.setdefault(a, set()).add(b)
    want = sorted({(a, c) for a, b in edges if a is not None for c in outs.get(b, ()) if c != a})
    assert rows(graph.two_hop_links(df)) == want == rows(graph.two_hop_links(df, heavy_pairs=200))
    first = df.where("dst like 'hub%' and src is not null").select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()
    second = df.where("src like 'hub%'").select(F.col("src").alias("b"), F.col("dst").alias("c")).distinct()
    plan = graph.hub_links(first, second)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and "Generate explode" in plan
    # what is exchanged before the links are made: a bitmap for each a and hub
    reached = first.join(second.select("b").distinct(), "b").count()
    assert reached < 20 * len(want) ** 0.5


def test_hub_links_over_many_chunks(spark):
    n = graph.CHUNK + 100
    first = spark.createDataFrame([(-1, 0), (5, 0), (5, 1)], "a long, b long")
    second = spark.range(n).selectExpr("id % 2 as b", "id * 3 as c")
    got = graph.hub_links(first, second).groupBy("a").agg(F.count("*").alias("n"), F.count_distinct("c").alias("d"), F.max("c").alias("m"))
    last = (n - 1) * 3 if (n - 1) % 2 == 0 else (n - 2) * 3
    assert rows(got, "a", "n", "d", "m") == [(-1, (n + 1) // 2, (n + 1) // 2, last), (5, n, n, (n - 1) * 3)]


def test_common_neighbours_with_repeats(spark):
    """Left repeats count, right ones do not; a hub, self-loops, ids of either sign; no array beyond a block."""
    import random

    rnd = random.Random(7)
    edges = [(rnd.randrange(-20, 20), rnd.randrange(-20, 20)) for _ in range(400)] + [(99, i) for i in range(-300, 300)] + [(i, 99) for i in range(-20, 20)]
    edges += [(99, 5)] * 3 + [(5, 99), (5, 5), (None, 1), (1, None)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(3)
    assert graph.neighbour_blocks(df, block=16).agg(F.max(F.size("ids"))).first()[0] <= 16
    known = [(u, v) for u, v in edges if u is not None and v is not None]
    lists = {}
    for u, v in known:
        lists.setdefault(u, []).append(v)
    want = sorted({(u, v, sum(x in set(lists.get(v, ())) for x in lists[u])) for u, v in known})
    assert rows(graph.common_neighbours(df, block=16)) == want == rows(graph.common_neighbours(df))


def test_pairs_of_a_middle_node_are_spread_over_tasks(spark, monkeypatch):
    """A node's pairs are joined in cells, in as many tasks as the pairs need: no task holds most of the links."""
    monkeypatch.setattr(graph, "CELL_PAIRS", 300)
    monkeypatch.setattr(graph, "TASK_PAIRS", 600)
    ins, outs = [f"a{i}" for i in range(60)] + [None], [f"c{i}" for i in range(59)] + ["a1"]
    edges = [(a, b) for a in ins for b in ("x", "y")] + [(b, c) for c in outs for b in ("x", "y")] + [("a1", "x")]
    df = spark.createDataFrame(edges, "src string, dst string").repartition(3)
    by = {}
    for a, b in edges:
        by.setdefault(a, set()).add(b)
    want = sorted({(a, c) for a, b in edges if a is not None for c in by.get(b, ()) if c != a})
    assert rows(graph.two_hop_links(df)) == want
    first = df.where("src is not null").distinct().toDF("a", "b")
    second = df.where("src is not null").distinct().toDF("b", "c")
    middle = spark.createDataFrame([("x", 3600), ("y", 3600)], "b string, pairs long")
    held = graph._links(first, second, middle, 7200).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in held) == 2 * (60 * 60 - 1) and max(r["count"] for r in held) < 3000


@pytest.mark.parametrize("item", ["word", "bigram"])
def test_line_windows_ship_lines_not_their_counts(spark, tmp_path, item):
    """Counts are made and ranked where a window's lines are; a window over several documents is whole."""
    import re
    from collections import Counter

    from quarry.plans.catalog import QUERIES
    docs = [(i, "\n".join(f"w{(i + j) % 3} w{j % 2} W{i % 4}, w0" for j in range(i % 5 + 1))) for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES[f"count_window_{item}_top10"](spark, str(tmp_path))
    assert not re.search(r"hashpartitioning\(window_id#\d+L?, \w+#", df._jdf.queryExecution().executedPlan().toString())
    lines = [x for _, t in docs for x in t.split("\n")]
    want = []
    for w in range(len(lines) // 10):
        n = Counter()
        for line in lines[w * 10:w * 10 + 10]:
            ws = re.findall(r"\w+", line if item == "word" else line.lower())
            n.update(ws if item == "word" else [f"{a} {b}" for a, b in zip(ws, ws[1:])])
        want += [(w, x, c, r) for r, (x, c) in enumerate(sorted(n.items(), key=lambda e: (-e[1], e[0]))[:10], 1)]
    assert rows(df, "window_id", item, "n", "rank") == sorted(want)
