from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from awkward import AWKWARD, docs

from quarry.llm import toxicity
from quarry.llm.words import Words, text_buffers
from quarry.sources.tables import load


def entries(texts):
    raw, off = text_buffers(pa.array(texts, pa.string()))
    return toxicity.terms(Words(raw, off, 0, len(texts)))


def brute_score(model, terms):
    z = model.bias + sum(float(model.w[i]) for i in terms)
    for a, i in enumerate(terms):
        for j in terms[a + 1:]:
            z += float(np.dot(model.v[i].astype(float), model.v[j].astype(float)))
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_score_is_the_pairwise_sum():
    rng = np.random.default_rng(0)
    size = 1 << toxicity.HASH_BITS
    model = toxicity.Model(-0.3, rng.normal(0, 0.1, size).astype(np.float32), rng.normal(0, 0.1, (size, 4)).astype(np.float32), toxicity.HASH_BITS)
    texts = ["", "one", "some words and some more words", "Ähnlich ähnlich", None, "x " * 500 + "y"]
    term, text = entries(texts)
    got = model.score(term, text, len(texts))
    for k in range(len(texts)):
        mine = term[text == k].tolist()
        assert len(mine) == len(set(mine))
        assert got[k] == pytest.approx(brute_score(model, mine), abs=1e-9)


def test_pairs_are_learnt():
    """Label 1 only where two terms meet; either alone is label 0."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(4_000):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        rows.append(np.unique(np.concatenate([rng.integers(100, 400, 15), [1] * a, [2] * b]).astype(int)))
        y.append(int(a and b))
    model = toxicity.fit(rows[:3_000], np.array(y[:3_000]), bits=10)
    test = rows[3_000:]
    p = model.score(np.concatenate(test), np.repeat(np.arange(1_000), [len(x) for x in test]), 1_000)
    assert ((p >= 0.5) == np.array(y[3_000:])).mean() > 0.97
    only = model.score(np.array([1, 2, 1, 2]), np.array([0, 1, 2, 2]), 3)
    assert only[0] < 0.3 and only[1] < 0.3 < 0.5 < only[2]


def test_terms_that_matter_only_in_company_are_learnt():
    """Label 1 where both terms are or neither is: alone they say nothing about it."""
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(5_000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.unique(np.concatenate([rng.integers(100, 400, 15), [1] * a, [2] * b]).astype(int)))
        y.append(int(a == b))
    model = toxicity.fit(rows[:4_000], np.array(y[:4_000]), bits=10)
    test = rows[4_000:]
    p = model.score(np.concatenate(test), np.repeat(np.arange(1_000), [len(x) for x in test]), 1_000)
    assert ((p >= 0.5) == np.array(y[4_000:])).mean() > 0.9


def test_held_out_ids_have_no_say(spark):
    d = docs(spark, [(i, "fine text" if i % 3 else "badword here") for i in range(1, 400)])
    rows = [(i, int(i % 3 == 0)) for i in range(1, 400)]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in rows]
    one, two = (toxicity.train(d, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (rows, flipped))
    assert one.bias == two.bias and (one.w == two.w).all() and (one.v == two.v).all()
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(d, one).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(r["predicted"] == int(i % 3 == 0) == int(r["score"] >= 0.3) for i, r in got.items())
    clean = toxicity.drop_toxic(d, one)
    assert clean.columns == d.columns and sorted(r["doc_id"] for r in clean.collect()) == [i for i in range(1, 400) if i % 3]


def test_awkward(spark):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, 1), (7, 1), (None, 1), (10, None), (11, 0), (999, 1), (1, 0), (2, 1)], "doc_id long, toxic int")
    d = docs(spark, AWKWARD)
    model = toxicity.train(d, labels)
    got = toxicity.toxicity_scores(d, model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity_scores(d.limit(0), model).collect() == []
    for few in (labels.limit(0), labels.where("toxic = 0")):
        assert all(r["predicted"] == 0 for r in toxicity.toxicity_scores(d, toxicity.train(d, few)).collect())
    none = toxicity.train(d.limit(0), labels)
    assert toxicity.drop_toxic(d, none).count() == len(AWKWARD)


def test_held_out_accuracy(spark):
    d, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    scored = toxicity.toxicity_scores(d, toxicity.train(d, labels)).where("held_out").join(labels, "doc_id").toPandas()
    hit = ((scored.predicted == 1) & (scored.toxic == 1)).sum()
    assert hit / (scored.toxic == 1).sum() > 0.85
    assert ((scored.predicted == 1) & (scored.toxic == 0)).sum() / (scored.toxic == 0).sum() < 0.02
