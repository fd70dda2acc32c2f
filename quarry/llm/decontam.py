"""Benchmark decontamination by winnowed k-gram fingerprints.

Of every ``window - k + 1`` consecutive k-gram hashes the smallest is kept
(all of them on a tie), in benchmark items and documents alike. A shared span
of ``window`` words holds a full winnowing window, so both sides keep the same
k-gram in it: no shared span of that length is missed. Kept fingerprints of a
document are looked up among the benchmark's, every hit is extended to the
windows over it, those are looked up among the benchmark's distinct windows,
and their words are compared byte by byte before they count.

A document's windows meet distinct windows, not their occurrences, so time and
memory grow with the number of words on either side, however often a word or a
passage repeats in a document, an item or over the items.

The benchmark is the stated query set: it is cut into blocks of bounded text
size, each broadcast on its own, and a task holds one block's index at a time,
so neither driver nor executors hold more than a block however large the
benchmark is. Documents are scanned once, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import Words, mix, slices, text_buffers

WINDOW = 10                     # words
K = 5                           # words of a k-gram
BLOCK_BYTES = 16 << 20          # benchmark text in one broadcast block
COMPARED = 16 << 20             # bytes of words compared at once
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class Windows:
    """The distinct windows of one length: hash (sorted; one that two windows share is there twice), the first word of
    one occurrence, and the items that hold it (``items[edge[i]:edge[i + 1]]``); ``kept``: their fingerprints."""
    kept: np.ndarray
    hash: np.ndarray
    at: np.ndarray
    items: np.ndarray
    edge: np.ndarray


@dataclass
class Index:
    """One block of items: their words, and their windows by length."""
    ids: list[str]
    words: Words
    windows: dict[int, Windows] = field(default_factory=dict)


def _grams(h: np.ndarray, text: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the largest value where they leave the text."""
    out = np.full(len(h), _NONE, dtype=np.uint64)
    n = len(h) - k + 1
    if n <= 0:
        return out
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    total = mix(total) >> np.uint64(1)
    out[:n] = np.where(text[:n] == text[k - 1:k - 1 + n], total, _NONE)
    return out


def _kept(g: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the smallest of some w consecutive ones."""
    n = len(g) - w + 1
    if n <= 0:
        return np.flatnonzero(g != _NONE)
    low = g[:n].copy()
    for j in range(1, w):
        np.minimum(low, g[j:j + n], out=low)
    keep = np.zeros(len(g), dtype=bool)
    for j in range(w):
        keep[j:j + n] |= g[j:j + n] == low
    return np.flatnonzero(keep & (g != _NONE))


def _window_hash(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each of the given words on."""
    total = np.zeros(len(at), dtype=np.uint64)
    for j in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[at + j]
    return mix(total)


def _same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words i of one text and j of another are the same bytes."""
    size = a.end[i] - a.start[i]
    same = size == b.end[j] - b.start[j]
    pair = np.flatnonzero(same)
    ends = np.cumsum(size[pair])
    s = 0
    while s < len(pair):                            # a bounded number of bytes at once, one pair at least
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + COMPARED, side="right")))
        part = pair[s:e]
        width = size[part]
        begin = np.cumsum(width) - width
        step = np.arange(int(width.sum())) - np.repeat(begin, width)
        equal = a.bytes[np.repeat(a.start[i[part]], width) + step] == b.bytes[np.repeat(b.start[j[part]], width) + step]
        same[part] = np.logical_and.reduceat(equal, begin)
        s = e
    return same


def _same_windows(a: Words, i: np.ndarray, b: Words, j: np.ndarray, n: int) -> np.ndarray:
    same = np.ones(len(i), dtype=bool)
    for x in range(n):
        left = np.flatnonzero(same)
        same[left] = _same_words(a, i[left] + x, b, j[left] + x)
    return same


def _distinct(w: Words, at: np.ndarray, kept: np.ndarray, n: int) -> Windows:
    """The distinct windows of length n among those that begin at the words ``at``."""
    h = _window_hash(w.hash, at, n)
    group = np.full(len(at), -1, dtype=np.int64)
    firsts: list[np.ndarray] = []
    open_, total = np.arange(len(at)), 0
    while len(open_):                               # again only for windows that share a hash with other words
        _, first, of = np.unique(h[open_], return_index=True, return_inverse=True)
        same = _same_windows(w, at[open_], w, at[open_[first]][of], n)
        group[open_[same]] = total + of[same]
        firsts.append(open_[first])
        open_, total = open_[~same], total + len(first)
    first = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.stack([group, w.text[at]]), axis=1) if len(at) else np.zeros((2, 0), dtype=np.int64)
    order = np.argsort(h[first], kind="stable")
    place = np.empty(len(first), dtype=np.int64)
    place[order] = np.arange(len(first))
    by = np.lexsort((pairs[1], place[pairs[0]])) if len(first) else np.zeros(0, dtype=np.int64)
    edge = np.searchsorted(place[pairs[0]][by], np.arange(len(first) + 1)) if len(first) else np.zeros(1, dtype=np.int64)
    return Windows(np.unique(kept), h[first][order], at[first][order], pairs[1][by], edge)


def build_index(items: list[tuple[str, str]], window: int = WINDOW, k: int = K) -> Index:
    raw, off = text_buffers(pa.array([t for _, t in items], pa.string()))
    w = Words(raw, off, 0, len(items))
    index = Index([i for i, _ in items], w)
    length = np.minimum(w.n_words, window)[w.text] if len(w.hash) else np.zeros(0, dtype=np.int64)
    last = np.cumsum(w.n_words)[w.text] if len(w.hash) else length              # one past the item's last word
    for n in np.unique(length).tolist():        # full windows, and each length of the items shorter than one
        size = min(k, n) if n == window else n
        g = np.where(length == n, _grams(w.hash, w.text, size), _NONE)
        at = np.flatnonzero((length == n) & (np.arange(len(length)) + n <= last))
        index.windows[n] = _distinct(w, at, g[_kept(g, n - size + 1)], n)
    return index


def _candidates(w: Words, known: Windows, n: int, size: int) -> np.ndarray:
    """First words of the windows over the document's kept fingerprints that the benchmark has."""
    g = _grams(w.hash, w.text, size)
    at = _kept(g, n - size + 1)
    if not len(known.kept):
        return at[:0]
    found = known.kept[np.minimum(np.searchsorted(known.kept, g[at]), len(known.kept) - 1)] == g[at]
    begins = np.zeros(len(w.hash), dtype=bool)
    for back in range(n - size + 1):
        begin = at[found] - back
        begins[begin[begin >= 0]] = True
    begin = np.flatnonzero(begins)
    begin = begin[begin + n <= len(w.hash)]
    return begin[w.text[begin] == w.text[begin + n - 1]]


def _hits(w: Words, index: Index, window: int, k: int) -> tuple[np.ndarray, set[tuple[int, int]]]:
    """Hit words of the slice, and the (text, item) pairs that share a window; words are compared byte by byte."""
    hit = np.zeros(len(w.hash) + 1, dtype=np.int64)
    pairs: set[tuple[int, int]] = set()
    for n, known in index.windows.items():
        at = _candidates(w, known, n, min(k, n) if n == window else n)
        h = _window_hash(w.hash, at, n)
        lo, hi = np.searchsorted(known.hash, h, side="left"), np.searchsorted(known.hash, h, side="right")
        while len(at := at[lo < hi]):               # more than once only where windows share a hash
            lo, hi = lo[lo < hi], hi[lo < hi]
            same = _same_windows(w, at, index.words, known.at[lo], n)
            hit[at[same]] += 1
            hit[at[same] + n] -= 1
            for t, i in np.unique(np.stack([w.text[at[same]], lo[same]]), axis=1).T.tolist():
                pairs.update((t, x) for x in known.items[known.edge[i]:known.edge[i + 1]].tolist())
            lo = lo + 1
    return np.cumsum(hit[:-1]) > 0, pairs


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about ``limit`` bytes of text, one item at least; the driver holds one block at a time."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    block: list[tuple[str, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        n = len(r["t"].encode())
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += n
    if block:
        yield block


def _scorer(benchmark: DataFrame, item_id: str, item_text: str, window: int, k: int,
            block_bytes: int) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, list[list[str]]]]:
    """A function of a text column: words, hit words, and item ids of each text."""
    sc = benchmark.sparkSession.sparkContext
    parts = [sc.broadcast(b) for b in _blocks(benchmark, item_id, item_text, block_bytes)]
    loaded: dict[int, Index] = {}

    def index_of(i: int) -> Index:
        if i not in loaded:
            loaded.clear()                                  # one block's index at a time
            loaded[i] = build_index(parts[i].load_from_path(parts[i]._path) if len(parts) > 1 else parts[i].value,
                                    window, k)
        return loaded[i]

    def score(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        raw, off = text_buffers(texts)
        n_words = np.zeros(len(texts), dtype=np.int64)
        ids: list[set[str]] = [set() for _ in range(len(texts))]
        marks: dict[int, np.ndarray] = {}
        for b in range(len(parts)):
            index = index_of(b)
            for i, j in slices(off):
                w = Words(raw, off, i, j)
                n_words[i:j] = w.n_words
                hit, pairs = _hits(w, index, window, k)
                for t, item in pairs:
                    ids[i + t].add(index.ids[item])
                if pairs:
                    edge = np.concatenate([[0], np.cumsum(w.n_words)])
                    for t in {t for t, _ in pairs}:
                        mine = hit[edge[t]:edge[t + 1]]
                        marks[i + t] = marks[i + t] | mine if i + t in marks else mine
        if not parts:
            for i, j in slices(off):
                n_words[i:j] = Words(raw, off, i, j).n_words
        n_hit = np.zeros(len(texts), dtype=np.int64)
        for t, m in marks.items():
            n_hit[t] = m.sum()
        return n_words, n_hit, [sorted(s) for s in ids]

    return score


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: id, n_words, n_hit, item_ids (sorted as strings).

    A window is ``window`` consecutive words of an item (all words of a shorter
    item); every word of a document inside an occurrence of a window is hit.
    Null and empty texts have no words and no hits, items without words have no
    windows, a null item id counts as the empty string, items that share an id
    count once. Repetitive texts of any length take time and memory in
    proportion to their words. Repeated rows come back repeated; an empty benchmark hits
    nothing; other columns are not read.
    """
    score = _scorer(benchmark, item_id, item_text, window, k, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, ids = score(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_hit), pa.array(ids, pa.list_(pa.string()))],
                names=[id_col, "n_words", "n_hit", "item_ids"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, item_ids array<string>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, k: int = K,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that share a window with the benchmark; columns and other rows as they are."""
    score = _scorer(benchmark, item_id, item_text, window, k, block_bytes)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, n_hit, _ = score(batch.column(at))
            yield batch.filter(pa.array(n_hit == 0))

    return docs.mapInArrow(run, docs.schema)


def ids_digest(ids: list[str]) -> str:
    """Lowercase hex SHA-256 of the comma-joined ids (for tests; queries use Spark's sha2)."""
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
