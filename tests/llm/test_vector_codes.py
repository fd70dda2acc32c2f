"""Exact vector codes against a plain version with integers of any length."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from quarry.llm import vector_codes as vc
from quarry.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, `a.b` int"


def brute(rows, parts=16, entries=64, rounds=2):
    whole = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not whole:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in whole) // parts)) * parts
    k = width // parts
    ints = [[math.floor(Fraction(x) * 256) for x in v] + [0] * (width - len(v)) for _, v, _ in whole]
    first = sorted(range(len(whole)), key=lambda n: (whole[n][0] is None, whole[n][0] or 0, whole[n][1]))[:entries]
    books = [[ints[n][p * k:(p + 1) * k] for n in first] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for x in ints:
                members[near(x[p * k:(p + 1) * k], books[p])[0]].append(x[p * k:(p + 1) * k])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else b for e, b in enumerate(books[p])]
    text = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for (i, _, label), x in zip(whole, ints):
        found = [near(x[p * k:(p + 1) * k], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{a:02x}" for a, _ in found), sum(d for _, d in found), label))
        by_label[label] += out[-1][2]
    long = lambda e: e if e < 1 << 63 else None
    return sorted(((i, c, long(e), long(by_label[label]), text) for i, c, e, label in out), key=str)


def query_on(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = QUERIES["op13_vector_codes"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str), stored


def test_random(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i * 7 % 211, [float(x) for x in rng.normal(size=32)], [None, 1, 2][i % 3]) for i in range(200)]
    got, stored = query_on(spark, tmp_path, rows)
    assert got == brute(stored)


def test_awkward(spark, tmp_path):
    rng = np.random.default_rng(4)
    some = [float(x) for x in rng.normal(size=20)]
    rows = [(1, None, 1), (2, [], 1), (3, [None] * 20, 2), (4, [float("nan")] * 20, 2), (5, [1.0, float("inf")], None),
            (6, some, None), (6, some, None), (6, some[::-1], 3), (None, some[:7], 3), (8, [-0.0] * 20, 3), (9, [0.00390625] * 17, 3)]
    got, stored = query_on(spark, tmp_path, rows)
    assert got == brute(stored) and len(got) == 7


def test_large_components(spark, tmp_path):
    rows = [(i, [float(2.0 ** (i % 30)) * s for s in (1, -1, 3, 0)] * 8, i % 2) for i in range(90)]
    rows += [(100, [1e30] * 32, 0), (101, [-3e38] * 32, 1), (102, [1e12] * 32, 2), (103, [1e12 + 1e6] * 32, 2)]
    got, stored = query_on(spark, tmp_path, rows)
    assert got == brute(stored)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_empty(spark, tmp_path, rows):
    assert query_on(spark, tmp_path, rows)[0] == []


@pytest.mark.parametrize("bits", [1, 3, 7, 13, 25, None])
def test_limbs(bits):
    rng = np.random.default_rng(bits or 0)
    for size in (1, 100, 1 << 20, 1 << 28):
        x, c = rng.integers(-size, size + 1, (40, 4)), rng.integers(-size, size + 1, (9, 4))
        want = [[sum(int(a) * int(b) for a, b in zip(r, e)) for e in c] for r in x]
        assert vc.dots(x, c, bits).tolist() == want
    for part in vc.limbs(x, bits or 25):
        assert np.abs(part).max() <= 2.0 ** (bits or 25)


def test_first_of_equal_distances():
    at, far = vc.nearest(np.array([[0, 0]]), np.array([[3, 4], [0, 5], [5, 0]]))
    assert at.tolist() == [0] and far.tolist() == [25]
