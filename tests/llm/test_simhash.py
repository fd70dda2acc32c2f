from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from awkward import AWKWARD, docs

from quarry.llm import simhash


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, radius=4):
    """{(id, fingerprint): component} of (id, text) rows."""
    fps = [brute_print(t) if len(t or "") < 10_000 else simhash.fingerprint((t or "").encode()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, fps[i], least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_masks_cover_every_pattern():
    rng = random.Random(1)
    for radius in (1, 2, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3_000):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
            assert any(flips & m == 0 for m in masks)


def test_fingerprint_by_hand():
    for t in ["", " ", "a", "A b", "Über die Straße ging é", "x y z w v u x y z w", "a\x0bb\x0cc\x1cd \x85e"]:
        assert simhash.fingerprint(t.encode()) == brute_print(t)


def test_groups_by_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = list(AWKWARD)
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 200))]
        for j in range(rng.randint(1, 4)):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((100 + 10 * i + j, " ".join(words)))
    got = simhash.simhash_groups(docs(spark, rows)).collect()
    assert Counter((r["doc_id"], r["fp"] & (2 ** 64 - 1), r["component_id"]) for r in got) == brute_groups(rows)
    assert simhash.simhash_groups(docs(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("limit", [4, 2048])
def test_links_of_a_dense_bucket_go_block_by_block(spark, limit):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 120:                       # one dense cloud, a chain, and strangers
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(range(64), 4)))
    fps |= set(chain) | {rng.getrandbits(64) for _ in range(100)}
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = {(r["u"], r["v"]) for r in simhash.fingerprint_links(df, 4, limit).collect()}
    x = np.array(signed)
    near = np.bitwise_count(x.view(np.uint64)[:, None] ^ x.view(np.uint64)[None, :]) <= 4

    def groups(pairs):
        label = {v: v for v in signed}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                m = min(label[a], label[b])
                changed |= label[a] != m or label[b] != m
                label[a] = label[b] = m
        return label

    truth = [(signed[i], signed[j]) for i, j in zip(*np.nonzero(near)) if i < j]
    assert groups(links) == groups(truth)


def test_keep_one(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (9, "other words stand here now"), (9, "other words stand here now"),
            (None, "a b c d e f g"), (4, None), (5, "")]
    d = docs(spark, rows).drop("block", "__n")
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        [("1", "a b c d e f g"), ("9", "other words stand here now"), ("None", "a b c d e f g"), ("4", "")])
    assert simhash.keep_one(d.limit(0)).collect() == []


def test_components(spark):
    from quarry.llm.components import components
    edges = [(i, i + 1) for i in range(50)] + [(100, 103), (103, 101), (101, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100, 103: 100}


@pytest.mark.parametrize("size", [1, 3, 7, 50, 1000])
def test_runs_over_many_batches(size):
    """A long bucket that comes in many batches: its links and blocks still join exactly what lies within 4 bits."""
    import pyarrow as pa

    rng = random.Random(size)
    rows = []
    for bucket, n in ((1, 1), (2, 90), (3, 2), (4, 60), (5, 1)):
        centre = rng.getrandbits(64)
        fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(n)}
        rows += [(bucket, f) for f in sorted(simhash._signed(x) for x in fps)]
    batches = [pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows[i:i + size]], pa.int64()),
                                           pa.array([f for _, f in rows[i:i + size]], pa.int64())], names=["bucket", "fp"])
               for i in range(0, len(rows), size)]
    links, blocks = [], {}
    for out in simhash._link_runs(4, 8)(iter(batches)):
        for r in out.to_pylist():
            if r["v"] is not None:
                links.append((r["u"], r["v"]))
            else:
                blocks.setdefault(r["bucket"], {}).setdefault(r["block"], set()).add(r["u"])
    for parts in blocks.values():
        ids = sorted(parts)
        for i in ids:
            for j in ids[:ids.index(i)]:
                links += simhash._stars(np.array(sorted(parts[j])), np.array(sorted(parts[i])), 4)
    label = {f: f for _, f in rows}

    def join(pairs):
        done = False
        while not done:
            done = True
            for a, b in pairs:
                m = min(label[a], label[b])
                done &= label[a] == m and label[b] == m
                label[a] = label[b] = m
        return dict(label)

    got = join(links)
    label.update({f: f for _, f in rows})
    want = join([(a, b) for x, a in rows for y, b in rows
                 if x == y and a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4])
    assert got == want
