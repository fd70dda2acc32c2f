"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the terms present
in the text: the linear weights catch terms that are toxic alone, the factors
catch pairs that are toxic only together. A term is a whole word or a word's
first 4 or 6 bytes, hashed; presence counts, not frequency.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import Words, slices, text_buffers

HASH_BITS = 18
PREFIXES = (4, 6)               # bytes; whole words besides
FACTORS = 8
TRAIN_ROWS = 16_000             # documented bound of the labelled sample the model is fitted on
EPOCHS = 6
BATCH = 128
THRESHOLD = 0.3
MIN_TEXTS = 3                   # training texts that a term has to occur in
MIN_STRENGTH = 3.0              # deviations from the base rate's log odds from which a term is fitted without penalty
PENALTY = 4.0                   # deviations of its gradient that a weaker term's weight or factors have to exceed


@dataclass
class Model:
    bias: float
    w: np.ndarray               # float32, 2^bits
    v: np.ndarray               # float32, 2^bits x factors
    bits: int

    def score(self, term: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        """Probabilities; ``term`` and ``text`` are distinct (term, text) entries."""
        live = self.live()[term]
        term, text = term[live], text[live]
        z = self.bias + np.bincount(text, self.w[term], n_texts)
        for f in range(self.v.shape[1]):
            x = self.v[term, f].astype(np.float64)
            z += 0.5 * (np.bincount(text, x, n_texts) ** 2 - np.bincount(text, x * x, n_texts))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def live(self) -> np.ndarray:
        return (self.w != 0) | self.v.any(axis=1)


def terms(w: Words, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (term, text) entries of a slice."""
    hashes = [w.hash] + [w.prefix_hash(n) for n in PREFIXES]
    term = np.concatenate(hashes) >> np.uint64(64 - bits)
    key = np.unique((np.tile(w.text, len(hashes)).astype(np.uint64) << np.uint64(bits)) | term)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), (key >> np.uint64(bits)).astype(np.int64)


def fit(rows: list[np.ndarray], label: np.ndarray, bits: int = HASH_BITS, factors: int = FACTORS,
        epochs: int = EPOCHS, seed: int = 7, rate: float = 0.1, l2: float = 1e-4,
        min_texts: int = MIN_TEXTS) -> Model:
    """AdaGrad on the log loss over a bounded sample; deterministic for a given order of rows.

    Every term of ``min_texts`` texts or more has a weight and factors. Those
    whose own log odds say little carry a lasso (a group lasso on the factors),
    so they stay at zero unless the loss, pairs included, asks for them.
    """
    size = 1 << bits
    empty = Model(-30.0, np.zeros(size, np.float32), np.zeros((size, factors), np.float32), bits)
    y = np.asarray(label, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        if len(y) and y.min() == 1:
            empty.bias = 30.0
        return empty
    # association with the label: smoothed log odds, in units of its deviation;
    # counted row by row (a row's terms are distinct), so the sample is never copied
    pos, n = np.zeros(size), np.zeros(size)
    for r, label_ in zip(rows, y):
        n[r] += 1
        pos[r] += label_
    base = y.mean()
    a = 0.5
    odds = (np.log((pos + a) / (n - pos + a)) - np.log(base / (1 - base)))
    strength = np.abs(odds) / np.sqrt(1 / (pos + a) + 1 / (n - pos + a))
    keep = np.flatnonzero(n >= min_texts)
    number = np.full(size, -1, dtype=np.int32)
    number[keep] = np.arange(len(keep))
    penalty = np.where(strength[keep] >= MIN_STRENGTH, 0.0, PENALTY) * np.sqrt(base * (1 - base) / n[keep])
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(keep)), rng.normal(0, 0.02, (len(keep), factors))
    bias = float(np.log(base / (1 - base)))
    gw, gv, gb = np.full(len(keep), 1e-6), np.full((len(keep), factors), 1e-6), 1e-6
    for _ in range(epochs):
        for start in range(0, len(rows), BATCH):
            part = [c[c >= 0] for c in (number[r] for r in rows[start:start + BATCH])]
            m = len(part)
            c, t = np.concatenate(part), np.repeat(np.arange(m), [len(x) for x in part])
            vc = v[c]
            sums = np.stack([np.bincount(t, vc[:, f], m) for f in range(factors)], axis=1)
            squares = np.bincount(t, (vc * vc).sum(axis=1), m)
            z = bias + np.bincount(t, w[c], m) + 0.5 * ((sums ** 2).sum(axis=1) - squares)
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[start:start + BATCH]
            gb += float((g.sum()) ** 2)
            bias -= rate * float(g.sum()) / np.sqrt(gb)
            u, inv, many = np.unique(c, return_inverse=True, return_counts=True)
            cost = many * penalty[u]
            dw = np.bincount(inv, g[t], len(u)) + l2 * w[u]
            gw[u] += dw ** 2
            step = rate / np.sqrt(gw[u])
            moved = w[u] - step * dw
            w[u] = np.sign(moved) * np.maximum(0.0, np.abs(moved) - step * cost)
            each = g[t, None] * (sums[t] - vc)
            dv = np.stack([np.bincount(inv, each[:, f], len(u)) for f in range(factors)], axis=1) + l2 * v[u]
            gv[u] += dv ** 2
            step = 0.5 * rate / np.sqrt(gv[u].mean(axis=1, keepdims=True))
            moved = v[u] - step * dv
            cost = cost * np.sqrt((sums ** 2).sum(axis=1).mean())
            norm = np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
            v[u] = moved * np.maximum(0.0, 1 - step * cost[:, None] / norm)
    empty.bias = bias
    empty.w[keep], empty.v[keep] = w, v
    return empty


def held_out(id_col: Column) -> Column:
    """True for ids whose crc32 (of the id as text) leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = TRAIN_ROWS, bits: int = HASH_BITS) -> Model:
    """Fit on at most ``max_rows`` labelled texts that are not held out.

    The sample is the labelled ids of smallest hash (a top-k over all labels);
    texts become term lists where they are read, and one task fits the model
    on them. Null labels, ids and texts without a label are left out. Without
    two classes the score is constant. Labels join on the id alone.
    """
    usable = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
              .where("__id is not null and __y in (0, 1)"))
    sample = (usable.where(~held_out(F.col("__id"))).groupBy("__id").agg(F.max("__y").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    texts = (docs.select(F.col(id_col).alias("__did"), F.col(text_col).cast("string").alias("__t"))
             .join(F.broadcast(sample), F.col("__did") == F.col("__id")))       # max_rows pairs of numbers at most

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_buffers(batch.column(2))
            lists: list[np.ndarray] = []
            for i, j in slices(off):
                w = Words(raw, off, i, j)
                term, text = terms(w, bits)
                edge = np.searchsorted(text, np.arange(w.n_texts + 1))
                lists += [term[edge[k]:edge[k + 1]].astype(np.int32) for k in range(w.n_texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))],
                                             names=["id", "y", "terms"])

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ys, rows = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            ys += batch.column(1).to_pylist()
            rows += [x.values.to_numpy() for x in batch.column(2)]
        first: dict = {}
        for k in sorted(range(len(ids)), key=lambda k: (ids[k], rows[k].tobytes())):
            first.setdefault(ids[k], k)                     # repeated rows of an id count once
        order = sorted(first.values(), key=lambda k: hashlib.md5(str(ids[k]).encode()).digest())
        model = fit([rows[k] for k in order], np.array([ys[k] for k in order]), bits)
        at = np.flatnonzero(model.live())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(model.w[at], np.float32(0)).astype(np.float64)),
             pa.array([*(x.astype(np.float64) for x in model.v[at]), np.array([model.bias])], pa.list_(pa.float64()))],
            names=["term", "w", "v"])

    kind = texts.select("__did").schema[0].dataType.simpleString()
    lists = (texts.select("__did", "__y", "__t")
             .mapInArrow(featurise, f"id {kind}, y int, terms array<int>"))
    got = lists.repartition(1).mapInArrow(fit_all, "term bigint, w double, v array<double>").collect()
    model = Model(-30.0, np.zeros(1 << bits, np.float32), np.zeros((1 << bits, FACTORS), np.float32), bits)
    for r in got:
        if r["term"] < 0:
            model.bias = r["v"][0]
        else:
            model.w[r["term"]], model.v[r["term"]] = r["w"], r["v"]
    return model


def _scorer(docs: DataFrame, model: Model) -> Callable[[pa.Array], np.ndarray]:
    # 2^bits x (factors + 1) floats, whatever the corpus; plain arrays, as workers need not know the class
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.w, model.v, model.bits))

    def score(texts: pa.Array) -> np.ndarray:
        model = Model(*shared.value)
        raw, off = text_buffers(texts)
        out = np.zeros(len(texts))
        for i, j in slices(off):
            w = Words(raw, off, i, j)
            term, text = terms(w, model.bits)
            out[i:j] = model.score(term, text, w.n_texts)
        return out

    return score


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: id, held_out, score, predicted.

    Whole texts are scored in one scan without a shuffle. Null and empty texts
    get the score of a text without terms. Repeated rows come back repeated, an
    empty table gives no rows, other columns are not read.
    """
    score = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1)))], names=[id_col, "score"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    scored = src.mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col("score"),
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns and other rows as they are."""
    score = _scorer(docs, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)
