"""SimHash near duplicates by covering locality-sensitive hashing.

Fingerprints that differ in at most ``radius`` bits are all found: bit i of the
fingerprint gets a non-zero vector m(i) of radius + 1 bits, and table v (every
non-zero vector of radius + 1 bits) keeps the bits with odd <m(i), v>. The
vectors of any ``radius`` differing bits leave some v orthogonal to all of
them, and that table's mask hides every differing bit, so the pair shares its
key there: 2^(radius+1) - 1 tables, no misses.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.tables import cut

BITS = 64
SEED = 42
RUN_LIMIT = 2048        # fingerprints of one bucket compared at once; larger buckets go block by block


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The bit masks of the tables (unsigned)."""
    vectors = range(1, 1 << (radius + 1))
    of_bit = [1 + i % len(vectors) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (of_bit[i] & v).bit_count() & 1) for v in vectors]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the text's word shingles, repeats included (unsigned)."""
    words = text.lower().split()        # bytes: A-Z only, and blanks 0x20 and 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    size = list(map(len, words))
    ends = list(accumulate(size, lambda a, b: a + 1 + b))
    k = min(shingle, len(words))
    starts = [e - n for e, n in zip(ends[:len(words) - k + 1], size)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:])], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, fp)`` of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every pair; counted unsigned, as numpy counts the bits of a signed number's absolute value."""
    return np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :])


def _stars(fps: np.ndarray, other: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning links (root, member) of the fingerprints within ``radius`` of each other.

    ``other``: a second block; then only links between the blocks are looked
    for. Breadth first: everything a frontier reaches leaves the open set, so a
    dense bucket costs few comparisons per fingerprint.
    """
    out: list[tuple[int, int]] = []
    if other is None:
        open_ = fps
        while len(open_):
            root, open_ = open_[0], open_[1:]
            frontier = np.array([root], dtype=np.int64)
            while len(frontier) and len(open_):
                reached = np.zeros(len(open_), dtype=bool)
                for i in range(0, len(frontier), 256):
                    left = np.flatnonzero(~reached)
                    if not len(left):
                        break
                    near = _distance(frontier[i:i + 256], open_[left]) <= radius
                    reached[left[near.any(axis=0)]] = True
                frontier, open_ = open_[reached], open_[~reached]
                out.extend((int(root), int(x)) for x in frontier)
        return out
    for i in range(0, len(fps), 256):                      # each right one to one left one, each left one likewise
        near = _distance(fps[i:i + 256], other) <= radius
        a, b = np.nonzero(near)
        if len(a):
            # a spanning forest of the bipartite links of this piece
            parent = list(range(len(near) + len(other)))

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for x, y in zip(a.tolist(), b.tolist()):
                rx, ry = find(x), find(len(near) + y)
                if rx != ry:
                    parent[ry] = rx
                    out.append((int(fps[i + x]), int(other[y])))
    return out


def _link_runs(radius: int, limit: int):
    """Over rows sorted by (bucket, fp): links inside each bucket; what exceeds ``limit`` comes back as blocks."""

    def emit(links: list[tuple[int, int]], over: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        u, v, bucket, block = ([x[0] for x in links], [x[1] for x in links], [None] * len(links), [None] * len(links))
        for b, k, fps in over:
            u += fps.tolist()
            v += [None] * len(fps)
            bucket += [b] * len(fps)
            block += [k] * len(fps)
        return pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(bucket, pa.int64()), pa.array(block, pa.int32())],
            names=["u", "v", "bucket", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_b = tail_f = np.zeros(0, dtype=np.int64)
        blocks = 0                                           # full blocks of the open run already handed on
        for batch in batches:
            b = np.concatenate([tail_b, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([tail_f, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(b):
                continue
            starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            ends = np.append(starts[1:], len(b))
            links: list[tuple[int, int]] = []
            over: list[tuple[int, int, np.ndarray]] = []
            for s, e in zip(starts[:-1], ends[:-1]):
                if blocks:                                   # the rest of a long run
                    over.append((int(b[s]), blocks, f[s:e]))
                    blocks = 0
                if e - s >= 2:
                    _close(f[s:e], int(b[s]), links, over)
            s = int(starts[-1])
            while len(b) - s > limit:                        # the run may go on: hand on full blocks
                over.append((int(b[s]), blocks, f[s:s + limit]))
                links += _stars(f[s:s + limit], None, radius)
                blocks += 1
                s += limit
            tail_b, tail_f = b[s:], f[s:]
            if links or over:
                yield emit(links, over)
        if len(tail_f):
            links, over = [], []
            if blocks:
                over.append((int(tail_b[0]), blocks, tail_f))
            if len(tail_f) >= 2:
                _close(tail_f, int(tail_b[0]), links, over)
            if links or over:
                yield emit(links, over)

    def _close(fps: np.ndarray, bucket: int, links: list, over: list) -> None:
        if len(fps) <= limit:
            links += _stars(fps, None, radius)
            return
        for k in range(0, len(fps), limit):
            part = fps[k:k + limit]
            over.append((bucket, k // limit, part))
            links += _stars(part, None, radius)

    return run


def fingerprint_links(fps: DataFrame, radius: int, limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the distinct fingerprints ``fp`` joined by chains within ``radius`` bits.

    Each bucket gives a spanning forest of its links instead of all pairs. A
    bucket of more than ``limit`` distinct fingerprints is cut into blocks:
    each block is linked at once and every pair of blocks is compared in a task
    of its own, so no bucket has to fit in one.
    """
    tables = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m))))
                       for t, m in enumerate(covering_masks(radius))])
    rows = fps.select(F.explode(tables).alias("bucket"), "fp")
    found = cut(rows.repartition("bucket").sortWithinPartitions("bucket", "fp")
                .mapInArrow(_link_runs(radius, limit), "u bigint, v bigint, bucket bigint, block int"), "simhash-links")
    links = found.where("v is not null").select("u", "v")
    over = found.where("v is null").select("bucket", "block", F.col("u").alias("fp"))
    if over.isEmpty():
        return links

    last = cut(over.groupBy("bucket").agg(F.max("block").alias("last")), "simhash-blocks")
    paired = (over.join(last, "bucket").where("last > 0")
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
              .where(F.col("with") != F.col("block"))
              .select("bucket", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"),
                      "block", "fp"))

    def between(table: pa.Table) -> pa.Table:
        block, fp = table.column("block").to_numpy(), table.column("fp").to_numpy()
        lo = block == table.column("lo").to_numpy()
        pairs = _stars(fp[lo], fp[~lo], radius)
        return pa.table({"u": pa.array([x for x, _ in pairs], pa.int64()), "v": pa.array([y for _, y in pairs], pa.int64())})

    return links.unionAll(paired.groupBy("bucket", "lo", "hi").applyInArrow(between, "u bigint, v bigint"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, radius: int = 4, limit: int = RUN_LIMIT) -> DataFrame:
    """``(id, fp, component_id)`` for every row: the smallest id reachable over links of ``radius`` bits or fewer.

    Texts are read once. Words are runs other than blanks (0x20, 0x09-0x0D)
    with A-Z lower-cased; a text of fewer words than ``shingle`` is one
    shingle, an empty or null text has fingerprint 0, which links like any
    other. Rows with equal fingerprints (exact copies) are one node, so copies
    are never compared. A null id is no candidate for the smallest; a group of
    null ids only has a null component. Repeated rows come back repeated. An
    empty table gives no rows. Other columns are not read.
    """
    prints = cut(with_fingerprint(docs, id_col, text_col, shingle), "simhash-prints")
    nodes = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    roots = components(fingerprint_links(nodes.select("fp"), radius, limit))
    # only fingerprints that are linked or repeated can have another row's id
    tied = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").where("n > 1 or root is not null")
    tied = cut(tied.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-tied")
    smallest = cut(tied.groupBy("root").agg(F.min("least").alias("__c")), "simhash-smallest")
    of_fp = cut(tied.select("fp", "root").join(smallest, "root").select(F.col("fp").alias("__fp"), "__c"), "simhash-of-fp")
    out = prints.join(of_fp, prints["fp"] == of_fp["__fp"], "left")
    return out.select(F.col(id_col), F.col("fp"), F.coalesce("__c", F.col(id_col)).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` without near duplicates: of each group the row with the smallest id stays.

    Columns are unchanged. Rows with a null id stay (no decision can name
    them). Rows that share an id count as one document: it goes if any of them
    is a later member of a group, and of its rows with equal texts one stays.
    """
    groups = simhash_groups(docs, id_col, text_col, shingle, radius)
    decided = cut(groups.where(F.col(id_col).isNotNull()).groupBy(id_col)
                  .agg(F.max((F.col("component_id") != F.col(id_col)).cast("int")).alias("__late"),
                       F.count(F.lit(1)).alias("__n")), "simhash-decided")
    late = decided.where("__late = 1").select(F.col(id_col).alias("__id"))
    kept = docs.join(late, docs[id_col] == late["__id"], "left_anti")
    repeated = decided.where("__late = 0 and __n > 1").select(F.col(id_col).alias("__id"))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, kept[id_col] == repeated["__id"], "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, kept[id_col] == repeated["__id"], "left_anti").unionByName(once)
