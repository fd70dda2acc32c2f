from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from awkward import AWKWARD, docs

from quarry.llm import decontam


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k:k + window]), set()).add("" if i is None else str(i))
    out = Counter()
    for d, t in rows:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[g]
        out[d, len(w), len(hit), tuple(sorted(ids))] += 1
    return out


@pytest.mark.parametrize("block_bytes", [1, 16 << 20])
@pytest.mark.parametrize("vocab", [3, 40])
def test_by_brute_force(spark, block_bytes, vocab):
    rng = random.Random(vocab)
    v = [rng.choice(["ab", "Ä", "x1", "zz", "é", "Q"]) + str(i) for i in range(vocab)]
    say = lambda n: " ".join(rng.choice(v) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 4, 5, 9, 10, 11, 25]))) for i in range(12)] + [(3, say(12)), (None, say(10)), (50, None), (51, "..")]
    rows = AWKWARD[:9] + AWKWARD[11:] + [(100 + i, say(rng.randint(0, 60))) for i in range(80)]
    rows += [(300 + i, say(7) + ", " + (t or "").upper() + "! " + say(5)) for i, (_, t) in enumerate(items)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs(spark, rows), bench, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in got) == brute(rows, items)
    clean = decontam.drop_contaminated(docs(spark, rows), bench, block_bytes=block_bytes)
    assert clean.columns == docs(spark, rows).columns
    want = Counter()
    for (d, _, hit, _), n in brute(rows, items).items():
        want[d] += n * (hit == 0)
    assert Counter(r["doc_id"] for r in clean.collect()) == +want


def test_empty_tables_and_long_texts(spark):
    bench = spark.createDataFrame([(1, "lorem ipsum dolor sit amet consectetur lorem ipsum dolor sit amet")], "item_id long, text string")
    none = decontam.contamination(docs(spark, AWKWARD), bench.limit(0)).collect()
    assert len(none) == len(AWKWARD) and all(r["n_hit"] == 0 and r["item_ids"] == [] for r in none)
    assert decontam.contamination(docs(spark, AWKWARD).limit(0), bench).collect() == []
    hit = {r["doc_id"]: r for r in decontam.contamination(docs(spark, AWKWARD), bench).collect()}
    # the windows end in "sit" and "amet", so the last word stays outside
    assert (hit[7]["n_words"], hit[7]["n_hit"], hit[8]["n_words"], hit[8]["n_hit"]) == (120_000, 119_999, 120_001, 119_999)


def test_word_hash_ties_are_compared_byte_by_byte(monkeypatch):
    """Words that agree in hash but not in bytes are no hit."""
    from quarry.llm.words import Words, text_buffers
    import numpy as np
    import pyarrow as pa
    index = decontam.build_index([("1", "a b c d e f g h i j")])
    raw, off = text_buffers(pa.array(["a b c d e f g h i x"]))
    w = Words(raw, off, 0, 1)
    w.hash = index.words.hash.copy()
    hit, pairs = decontam._hits(w, index, 10, 5)
    assert not hit.any() and not pairs
    assert np.array_equal(w.n_words, [10])


def test_neighbouring_items_and_documents_of_one_word(spark):
    items = [(1, "yes"), (2, "no"), (3, "maybe"), (4, "two words")]
    rows = [(1, "yes no"), (2, "well yes"), (3, "no well"), (4, "maybe"), (5, "yes"), (6, "no"), (7, "well"), (8, "two words yes no maybe")]
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    d = docs(spark, rows).coalesce(1).orderBy("doc_id")
    got = decontam.contamination(d, bench).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in got) == brute(rows, items)
    assert [r["doc_id"] for r in decontam.drop_contaminated(d, bench).collect()] == [7]


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    """With one hash for all windows, items and hits are still those of the words themselves."""
    import numpy as np
    import pyarrow as pa
    from quarry.llm.words import Words, text_buffers

    monkeypatch.setattr(decontam, "_window_hash", lambda h, at, n: np.full(len(at), 7, dtype=np.uint64))
    items = [("1", "a b c d e f g h i j k"), ("2", "b c d e f g h i j k l"), ("3", "x y")]
    index = decontam.build_index(items)
    rows = [(0, "x a b c d e f g h i j y"), (1, "z b c d e f g h i j k l x y")]
    raw, off = text_buffers(pa.array([t for _, t in rows]))
    hit, pairs = decontam._hits(Words(raw, off, 0, 2), index, 10, 5)
    want = brute(rows, items)
    assert {(t, tuple(sorted(index.ids[i] for u, i in pairs if u == t))) for t in (0, 1)} == {(d, ids) for d, _, _, ids in want}
    assert int(hit.sum()) == sum(n for _, _, n, _ in want)


@pytest.mark.parametrize("items, text", [
    (["buy now " * 10_000], "buy now " * 10_000),
    (["spam " * 20_000], "spam " * 20_000),
    ([f"q{i} " + " ".join(f"p{j}" for j in range(30)) for i in range(10_000)], " ".join(f"p{j}" for j in range(30)) + " " + "filler " * 100 + "; "),
    (["a b c d e f g h i j"] * 5_000, "a b c d e f g h i j " * 500),
])
def test_repetition_takes_linear_time_and_memory(items, text):
    """Repeated words and passages on both sides: seconds and less than a GB, with the plain version's hits."""
    import time
    import tracemalloc

    import pyarrow as pa
    from quarry.llm.words import Words, text_buffers

    tracemalloc.start()
    began = time.time()
    named = [(str(i), t) for i, t in enumerate(items)]
    index = decontam.build_index(named)
    raw, off = text_buffers(pa.array([text]))
    hit, pairs = decontam._hits(Words(raw, off, 0, 1), index, 10, 5)
    took, most = time.time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 60 and most < 1 << 30
    (_, _, n_hit, ids), = brute([(0, text)], named)
    assert int(hit.sum()) == n_hit and {index.ids[i] for _, i in pairs} == set(ids) and n_hit
