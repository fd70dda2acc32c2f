"""The Merkle manifest against a plain version that builds every tree in lists."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from awkward import AWKWARD, docs
from pyspark.sql import functions as F

from quarry.llm import merkle
from quarry.llm.queries import QUERIES


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc, text) -> str:
    return h("".join(map(field, (doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text))))


def tree(level):
    """All levels, from the leaves to the root."""
    levels = [level]
    while len(level) > 1:
        level = [h("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        levels.append(level)
    return levels


def way(levels, at):
    """(digits, siblings) from the leaf up."""
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        out.append((at % 8, run[:at % 8] + run[at % 8 + 1:]))
        at //= 8
    return out


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    of = {}
    for g in names:
        ordered = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        of[g] = (ordered, tree([leaf_of(r, r["text"]) for r in ordered]))
    top = tree([of[g][1][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        ordered, levels = of[g]
        for at, r in enumerate(ordered):
            path = way(levels, at) + way(top, place)
            leaf = leaf_of(r, r["text"])
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            x = leaf_of(r, None if r["text"] is None else lower(r["text"])) if hit else leaf
            for digit, others in path:
                x = h("".join(others[:digit] + [x] + others[digit:]))
            proof = h("".join(d for _, others in path for d in others))
            out.append((r["doc_id"], leaf, levels[-1][0], top[-1][0], proof, x, x == top[-1][0]))
    return sorted(out, key=str)


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def query_on(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_merkle"](spark, str(tmp_path))
    assert got.columns == COLS
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_sizes(spark, tmp_path, n):
    rows = [(i * 3 % n, f"Text {i}" * (i % 5), ["en", "de", None][i % 3 if i % 7 else 0], f"s{i}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert query_on(spark, tmp_path, df) == brute([r.asDict() for r in df.collect()])


def test_many_groups(spark, tmp_path):
    rows = [(i, "T", f"l{i % 100:02d}" if i % 101 else "", "s", i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert query_on(spark, tmp_path, df) == brute([r.asDict() for r in df.collect()])


def test_awkward(spark, tmp_path):
    df = docs(spark, AWKWARD).withColumns({"grp": F.lit("x"), "rank": F.lit(1), "leaf": F.lit("y"), "a.b": F.lit(2)})
    df = df.withColumn("lang", F.when(F.col("`doc_id`") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("lang")))
    df = df.withColumn("source", F.when(F.col("doc_id") == 5, F.lit(None).cast("string")).otherwise(F.col("source")))
    assert query_on(spark, tmp_path, df) == brute([r.asDict() for r in df.collect()])


def test_equal_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "Same", "en", "s", 4)] * 100 + [(None, None, None, None, None)] * 20,
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert query_on(spark, tmp_path, df) == brute([r.asDict() for r in df.collect()])


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert query_on(spark, tmp_path, df) == []


def test_some_requests(spark):
    rows = spark.range(700).select(merkle.group_key(F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 5))).alias("grp"), "id",
                                   merkle.leaf_digest([F.col("id")]).alias("leaf"))
    made = merkle.manifest(rows, ["id"])
    every = {r.id: r for r in made.proofs().collect()}
    some = {r.id: r for r in made.proofs(made.leaves.where("id % 50 = 7")).collect()}
    assert sorted(some) == [i for i in range(700) if i % 50 == 7]
    assert all(some[i].path == every[i].path and some[i].subroot == every[i].subroot for i in some)
    assert made.proofs().where(merkle.fold(F.col("leaf"), F.col("path")) == made.root).count() == 700
    # a record's digest names its content, and is stored once
    records = made.tree.records(1)
    assert records.where(F.sha2("children", 256) != F.col("digest")).count() == 0
