"""Embedding near duplicates over a robust-pruned flat graph.

Every vector belongs to the nearest cell of a clustering. Each cell's vectors
get a graph whose adjacency lists are robust-pruned. Every vector then searches
all cells whose centre is at most a margin further than its nearest one, from
their medoids: a greedy beam first, then the range expands over every vertex
within the threshold. The margin is what isotropic neighbours at the threshold
need, and as much more as a sample of the vectors, compared with all others,
asks for; so it does not depend on the number of cells. Each block of queries
audits its recall on some of them against all vectors of the cell and widens
its beam while it falls short. Links are decided by the cosine in double
precision.

A cell of more vectors than one task should hold is cut into chunks with a
graph each, and all queries of the cell search all its chunks, so no cluster
has to fit in one task. Equal vectors are one vertex with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.tables import cut

CELL = 1024             # vectors whose nearest cell this is, on average
CHUNK = 4096            # vectors of one graph
QUERIES = 2048          # queries of one search task
REACH = 2.25            # margin in deviations of an isotropic neighbour at the threshold
ASKED = 1024            # vectors of each size that are compared with all others for the margin
MARGIN_RECALL = 0.99    # share of their neighbours that the margin reaches, in each band of cosines
BANDS, GAP_STEPS = 4, 200
MAX_CELLS = 16_384
SAMPLE_PER_CELL = 32    # rows that the clustering is fitted on: at most 32 x 16,384
NEAR, FAR = 20, 4       # pruned neighbours among the nearest, and among some drawn at random
CANDIDATES, DRAWN = 48, 16
ALPHA = 1.2
BEAM = 16
ENTRIES = 16
AUDIT = 128             # audited queries of a search task
AUDIT_RECALL = 0.98


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first so that squares neither overflow nor vanish."""
    x = rows / np.abs(rows).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(col), -1)) if len(col) else np.zeros((0, 1))


def _pick_diverse(x: np.ndarray, at: np.ndarray, cand: np.ndarray, keep: int) -> np.ndarray:
    """Robust pruning of each row's candidates (sorted by similarity): the nearest stays, and what is nearer to it goes."""
    g = x[cand]
    to_row = 2 - 2 * np.einsum("bcd,bd->bc", g, x[at])
    between = 2 - 2 * np.matmul(g, g.transpose(0, 2, 1))
    alive = cand != at[:, None]
    out = np.full((len(at), keep), -1, dtype=np.int64)
    row = np.arange(len(at))
    for k in range(keep):
        first = alive.argmax(axis=1)
        has = alive[row, first]
        if not has.any():
            break
        out[has, k] = cand[row, first][has]
        alive &= ALPHA * ALPHA * between[row, first] > to_row
        alive[row, first] = False
    return out


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row, with the links turned round as well."""
    m = len(x)
    rng = np.random.default_rng(m)
    lists: list[np.ndarray] = []
    for i in range(0, m, 256):
        at = np.arange(i, min(i + 256, m))
        s = x[at] @ x.T
        c = min(CANDIDATES + 1, m)
        near = np.argpartition(-s, c - 1, axis=1)[:, :c]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, axis=1), axis=1, kind="stable"), axis=1)
        far = rng.integers(0, m, (len(at), DRAWN))
        far = np.take_along_axis(far, np.argsort(-np.take_along_axis(s, far, axis=1), axis=1, kind="stable"), axis=1)
        lists += list(np.concatenate([_pick_diverse(x, at, near, NEAR), _pick_diverse(x, at, far, FAR)], axis=1))
    src = np.repeat(np.arange(m), NEAR + FAR)
    dst = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
    src, dst = src[dst >= 0], dst[dst >= 0]
    # a turned link is kept for up to as many as a vertex may have of its own
    order = np.argsort(dst, kind="stable")
    back, of = src[order], dst[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    back, of = back[rank < NEAR], of[rank < NEAR]
    pairs = np.unique(np.concatenate([src * m + dst, of * m + back])) if m else np.zeros(0, dtype=np.int64)
    edge = np.searchsorted(pairs // max(m, 1), np.arange(m + 1))
    return [pairs[edge[v]:edge[v + 1]] % m for v in range(m)]


def medoids(x: np.ndarray, adj: np.ndarray) -> np.ndarray:
    """Entry points: the medoids of some clusters, and one vertex of every part that they cannot reach."""
    m = len(x)
    seeds = np.unique(np.linspace(0, m - 1, min(ENTRIES, m)).astype(int))
    near = (x @ x[seeds].T).argmax(axis=1)
    out = []
    for k in range(len(seeds)):
        mine = np.flatnonzero(near == k)
        if len(mine):
            out.append(int(mine[(x[mine] @ x[mine].mean(axis=0)).argmax()]))
    reached = np.zeros(m + 1, dtype=bool)
    reached[m] = True
    frontier = np.array(sorted(set(out)))
    entries = list(frontier)
    while True:
        reached[frontier] = True
        while len(frontier):
            frontier = np.unique(adj[frontier])
            frontier = frontier[~reached[frontier]]
            reached[frontier] = True
        rest = np.flatnonzero(~reached)
        if not len(rest):
            return np.array(entries)
        frontier = rest[:1]
        entries.append(int(rest[0]))


def range_search(x: np.ndarray, adj: np.ndarray, entries: np.ndarray, q: np.ndarray, threshold: float,
                 beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vertex) with cosine >= threshold that the graph leads to; ``adj`` is padded with len(x)."""
    m = len(x)
    padded = np.vstack([x, np.zeros((1, x.shape[1]))])
    found_q, found_v = [], []
    for i in range(0, len(q), 256):
        qs = q[i:i + 256]
        b = len(qs)
        seen = np.zeros((b, m + 1), dtype=bool)
        seen[:, m] = True
        seen[:, entries] = True
        row = np.arange(b)
        sims = qs @ x[entries].T
        ids = np.tile(entries, (b, 1))
        hit_q, hit_v = np.nonzero(sims >= threshold)
        pairs = [(hit_q, entries[hit_v])]
        if ids.shape[1] > beam:
            top = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            ids, sims = np.take_along_axis(ids, top, axis=1), np.take_along_axis(sims, top, axis=1)
        done = np.zeros(ids.shape, dtype=bool)
        while True:                                             # greedy: the best open vertex of every beam
            best = np.where(done, -3.0, sims)
            at = best.argmax(axis=1)
            act = np.flatnonzero(best[row, at] > -2.5)
            if not len(act):
                break
            done[act, at[act]] = True
            nb = adj[ids[act, at[act]]]
            new = ~seen[act[:, None], nb]
            seen[act[:, None], nb] = True
            s = np.where(new, np.einsum("bad,bd->ba", padded[nb], qs[act]), -3.0)
            a, c = np.nonzero(s >= threshold)
            pairs.append((act[a], nb[a, c]))
            all_ids = np.concatenate([ids[act], nb], axis=1)
            all_s = np.concatenate([sims[act], s], axis=1)
            all_done = np.concatenate([done[act], ~new], axis=1)
            k = ids.shape[1]
            if k < beam:                                        # grow to the beam's width first
                wide = min(beam, all_ids.shape[1])
                grow = wide - k
                ids = np.concatenate([ids, np.full((b, grow), m)], axis=1)
                sims = np.concatenate([sims, np.full((b, grow), -3.0)], axis=1)
                done = np.concatenate([done, np.ones((b, grow), dtype=bool)], axis=1)
                k = wide
            top = np.argpartition(-all_s, k - 1, axis=1)[:, :k]
            ids[act] = np.take_along_axis(all_ids, top, axis=1)
            sims[act] = np.take_along_axis(all_s, top, axis=1)
            done[act] = np.take_along_axis(all_done, top, axis=1)
        fq, fv = (np.concatenate(c) for c in zip(*pairs))
        found_q.append(fq + i)
        found_v.append(fv)
        while len(fq):                                          # the range expands over what is within it
            next_q, next_v = [], []
            for j in range(0, len(fq), 8192):
                nb = adj[fv[j:j + 8192]]
                rq = np.repeat(fq[j:j + 8192], nb.shape[1])
                nv = nb.ravel()
                fresh = ~seen[rq, nv]
                key = np.unique(rq[fresh] * (m + 1) + nv[fresh])
                rq, nv = key // (m + 1), key % (m + 1)
                seen[rq, nv] = True
                ok = np.einsum("pd,pd->p", x[nv], qs[rq]) >= threshold
                next_q.append(rq[ok])
                next_v.append(nv[ok])
            fq, fv = np.concatenate(next_q), np.concatenate(next_v)
            found_q.append(fq + i)
            found_v.append(fv)
    if not found_q:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_q), np.concatenate(found_v)


def audited_search(x: np.ndarray, adj: np.ndarray, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """``range_search`` with a beam that is doubled while some audited queries miss what a full scan finds."""
    entries = medoids(x, adj)
    audit = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    exact = int((q[audit] @ x.T >= threshold).sum())
    beam = BEAM
    while True:
        fq, fv = range_search(x, adj, entries, q, threshold, beam)
        if np.isin(fq, audit).sum() >= AUDIT_RECALL * exact or beam >= len(x):
            return fq, fv
        beam *= 2


def _fit_cells(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; an empty cell keeps its centre."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), centres)
    return centres


def _star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number joined to each of 0..n-1 by the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _vertices(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows ``(id, name)`` and the distinct valid vectors ``(node, name, salt, dim, vec, least, n)``.

    A vector's name is 128 bits of hash (null for invalid ones), ``node`` a
    short number that is given once, when the table is written, and ``salt`` a
    hash to deal vectors by.
    """
    v = F.col("vec")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)
    name = F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(v), F.xxhash64(v, F.lit(1)))])
    rows = cut(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
               .select("id", F.when(F.coalesce(valid, F.lit(False)), name).alias("name"), "vec"), "graph-rows")
    nodes = (rows.where("name is not null").groupBy("name")
             .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
             .select(F.monotonically_increasing_id().alias("node"), "name", F.xxhash64("name").alias("salt"),
                     F.size("vec").alias("dim"), "vec", "least", "n"))
    return rows.select("id", "name"), cut(nodes, "graph-nodes")


def _margins(nodes: DataFrame, centres: dict[int, np.ndarray], threshold: float) -> dict[int, float]:
    """For each size of vector, how much less similar than the nearest a centre may be to be visited.

    A bounded sample of queries is compared with all vertices. Neighbours are
    counted by band of cosine, so that many close ones do not hide the others.
    """
    asked = {}
    out = {}
    for d, c in centres.items():
        part = nodes.where(F.col("dim") == d).orderBy("salt", "name").limit(ASKED).select("vec").toArrow()
        q = _matrix(part.column("vec"))
        asked[d] = (q, q @ c.T)
        spread = math.sqrt(max(0.0, 1 - threshold * threshold)) / threshold if threshold > 0 else math.inf
        out[d] = min(2.0, max(1 / GAP_STEPS, REACH * spread * math.sqrt(2 / d)))
    shared = nodes.sparkSession.sparkContext.broadcast((asked, centres))
    width = max((1 - threshold) / BANDS, 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, centres = shared.value
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                x = _matrix(batch.column(1).take(pa.array(np.flatnonzero(dims == d))))
                home = (x @ centres[d].T).argmax(axis=1)
                q, to_centre = asked[d]
                s = q @ x.T
                a, b = np.nonzero((s >= threshold) & (s < 1 - 1e-12))
                gap = to_centre[a].max(axis=1) - to_centre[a, home[b]]
                band = np.minimum(((s[a, b] - threshold) / width).astype(int), BANDS - 1)
                step = np.minimum(np.ceil(gap * GAP_STEPS / 2).astype(int), GAP_STEPS)
                key, n = np.unique(band * (GAP_STEPS + 1) + step, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(key), pa.int32()), pa.array(key // (GAP_STEPS + 1), pa.int32()),
                     pa.array(key % (GAP_STEPS + 1), pa.int32()), pa.array(n, pa.int64())],
                    names=["dim", "band", "step", "n"])

    seen = (nodes.select("dim", "vec").mapInArrow(run, "dim int, band int, step int, n bigint")
            .groupBy("dim", "band", "step").agg(F.sum("n").alias("n")).collect())      # BANDS x GAP_STEPS a size at most
    counts: dict[tuple[int, int], np.ndarray] = {}
    for r in seen:
        counts.setdefault((r["dim"], r["band"]), np.zeros(GAP_STEPS + 1))[r["step"]] = r["n"]
    for (d, _), n in counts.items():
        need = int(np.searchsorted(np.cumsum(n), MARGIN_RECALL * n.sum() - 1e-9))
        out[d] = max(out[d], need * 2 / GAP_STEPS)
    return out


def _cells(nodes: DataFrame, cell: int, threshold: float) -> DataFrame:
    """Every vertex with its cell and the cells it visits: ``(node, salt, vec, n, cell, visits)``; cells of different sizes of vector differ."""
    spark = nodes.sparkSession
    centres: dict[int, np.ndarray] = {}
    base: dict[int, int] = {}
    for r in nodes.groupBy("dim").count().orderBy("dim").collect():
        k = max(1, min(MAX_CELLS, math.ceil(r["count"] / cell)))
        want = max(1024, SAMPLE_PER_CELL * k)
        part = nodes.where(F.col("dim") == r["dim"])
        share = max(1, r["count"] // (2 * want))                # names are hashes: this is a plain sample
        drawn = (part.where(F.pmod("salt", F.lit(share)) == 0).orderBy("name").limit(want)
                 .select("vec").toArrow())
        sample = _matrix(drawn.column("vec"))
        base[r["dim"]] = sum(len(c) for c in centres.values())
        centres[r["dim"]] = _fit_cells(sample, min(k, len(sample)))
    margins = _margins(nodes, centres, threshold)
    shared = spark.sparkContext.broadcast((centres, base, margins))     # at most 16,384 centres a size of vector

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, base, margins = shared.value
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            cell, visits = np.zeros(len(dims), dtype=np.int32), [None] * len(dims)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                s = _matrix(batch.column(3).take(pa.array(at))) @ centres[d].T
                cell[at] = s.argmax(axis=1) + base[d]
                near = s >= s.max(axis=1, keepdims=True) - margins[d]
                for i, row in zip(at.tolist(), near):
                    visits[i] = np.flatnonzero(row).astype(np.int32) + base[d]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (0, 1, 3, 4)), pa.array(cell), pa.array(visits, pa.list_(pa.int32()))],
                names=["node", "salt", "vec", "n", "cell", "visits"])

    vec = nodes.schema["vec"].dataType.simpleString()
    placed = (nodes.select("node", "salt", "dim", "vec", "n")
              .mapInArrow(run, f"node bigint, salt bigint, vec {vec}, n bigint, cell int, visits array<int>"))
    return cut(placed, "graph-cells")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                    cell: int = CELL, chunk: int = CHUNK, queries: int = QUERIES) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Every valid row is indexed and every valid row is a query. ``n_links``
    counts the other rows linked directly (copies included), ``component_id``
    is the smallest id reachable, ``kept`` says that it is the row's own.
    Vectors that are null, empty or all zero, or hold null or non-finite
    components link with nothing; vectors of different sizes do not link. A
    null id is no candidate for the smallest, and a null-id row's ``kept`` is
    false if its group has an id. Repeated rows link with each other. An empty
    table gives no rows; other columns are not read. Runs jobs.
    """
    rows, nodes = _vertices(vectors, id_col, vec_col)
    placed = _cells(nodes, cell, threshold)
    visits = placed.select("node", "salt", "vec", F.explode("visits").alias("cell"))
    sizes = cut(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
                .join(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("blocks")), "cell"),
                "graph-sizes")
    dealt = placed.drop("visits").join(sizes, "cell").withColumn("chunk", F.pmod("salt", F.col("chunks")).cast("int"))

    def graph(table: pa.Table) -> pa.Table:
        table = table.sort_by("salt")
        nodes_ = table.column("node").to_numpy()
        lists = build_graph(_matrix(table.column("vec")))
        return pa.table({"node": pa.array(nodes_), "adj": pa.array([nodes_[x] for x in lists], pa.list_(pa.int64()))})

    lists = (dealt.select("cell", "chunk", "node", "salt", "vec").groupBy("cell", "chunk")
             .applyInArrow(graph, "node bigint, adj array<bigint>"))
    flat = cut(lists, "graph-flat")

    def search(nodes_: pa.Table, asking: pa.Table) -> pa.Table:
        kind = {"node": pa.int64(), "other": pa.int64(), "links": pa.int64()}
        if not len(nodes_) or not len(asking):
            return pa.table({c: pa.array([], t) for c, t in kind.items()})
        nodes_ = nodes_.sort_by("node")
        names, q_names = nodes_.column("node").to_numpy(), asking.column("node").to_numpy()

        def number(values: np.ndarray) -> np.ndarray:
            """Places of the values among the cell's vertices, -1 for others."""
            at = np.minimum(np.searchsorted(names, values), len(names) - 1)
            return np.where(names[at] == values, at, -1)

        lists_ = nodes_.column("adj").combine_chunks()
        edge = np.concatenate([[0], np.cumsum(lists_.value_lengths().to_numpy(zero_copy_only=False))])
        near = number(lists_.flatten().to_numpy(zero_copy_only=False))
        adj = np.full((len(names), max(1, int(np.diff(edge).max()))), len(names), dtype=np.int64)
        for i in range(len(names)):
            mine = near[edge[i]:edge[i + 1]]
            mine = mine[mine >= 0]
            adj[i, :len(mine)] = mine
        x, q = _matrix(nodes_.column("vec")), _matrix(asking.column("vec"))
        fq, fv = audited_search(x, adj, q, threshold)
        number_q = number(q_names)
        other = number_q[fq] != fv
        fq, fv = fq[other], fv[other]
        # a vertex is in one chunk of one cell, so no pair is found twice
        weight = np.array(nodes_.column("n").to_pylist(), dtype=np.float64)
        counts = np.bincount(fq, weight[fv], len(q_names)).astype(np.int64)
        # a star for each group of linked vertices instead of all pairs
        every = np.concatenate([names, q_names[number_q < 0]])
        at = number_q.copy()
        at[at < 0] = len(names) + np.arange((number_q < 0).sum())
        label = _star(len(every), at[fq], fv)
        tied = np.flatnonzero(label != np.arange(len(every)))
        return pa.table({
            "node": pa.array(np.concatenate([q_names, every[tied]])),
            "other": pa.array([None] * len(q_names) + every[label[tied]].tolist(), kind["other"]),
            "links": pa.array(counts.tolist() + [None] * len(tied), kind["links"])})

    keys = ["cell", "chunk", "block"]
    held = (dealt.join(flat, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*keys, "node", "vec", "n", "adj"))
    asking = (visits.join(sizes, "cell")
              .withColumn("block", F.pmod(F.xxhash64("salt"), F.col("blocks")).cast("int"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select(*keys, "node", "vec").toDF(*keys, "node", "vec"))
    found = cut(held.groupBy(*keys).cogroup(asking.groupBy(*keys))
                .applyInArrow(search, "node bigint, other bigint, links bigint"), "graph-found")

    links = cut(found.where("other is null").groupBy("node").agg(F.sum("links").alias("links")), "graph-links")
    roots = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    tied = cut(nodes.select("node", "name", "least", "n").join(links, "node", "left")
               .join(roots.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
               .select("name", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("root", "node").alias("root")), "graph-tied")
    smallest = cut(tied.groupBy("root").agg(F.min("least").alias("c")), "graph-smallest")
    of_node = cut(tied.join(smallest, "root").select(F.col("name").alias("t_name"), "n_links", "c"), "graph-of-node")
    out = rows.join(of_node, F.col("name") == F.col("t_name"), "left")
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def audit(vectors: DataFrame, result: DataFrame, threshold: float = 0.9, every: int = 100, id_col: str = "vec_id",
          vec_col: str = "embedding", block: int = 4096) -> DataFrame:
    """``(queries, links, true_links)``: the result's links of the rows whose id is divisible by ``every`` against a full scan.

    The queries go over all rows in blocks of bounded size, one broadcast each,
    and every task returns one count a batch.
    """
    spark = vectors.sparkSession
    _, nodes = _vertices(vectors, id_col, vec_col)
    asked = _vertices(vectors.where(F.col(id_col) % every == 0), id_col, vec_col)[1]
    truth = None
    held: list = []

    def count(rows: list) -> DataFrame:
        by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in {len(r["vec"]) for r in rows}:
            mine = [r for r in rows if len(r["vec"]) == d]
            by_dim[d] = (unit(np.array([r["vec"] for r in mine], dtype=np.float64)), np.array([r["n"] for r in mine]))
        shared = spark.sparkContext.broadcast(by_dim)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, total = np.array(batch.column(1).to_pylist()), 0
                dims = np.array([len(v) for v in batch.column(0)])
                for d, (q, w) in shared.value.items():
                    at = np.flatnonzero(dims == d)
                    if len(at):
                        near = _matrix(batch.column(0).take(pa.array(at))) @ q.T >= threshold
                        total += int(n[at] @ near @ w)
                yield pa.RecordBatch.from_arrays([pa.array([total])], names=["t"])

        return nodes.select("vec", "n").mapInArrow(run, "t bigint")

    for r in asked.select("vec", "n").toLocalIterator():
        held.append(r)
        if len(held) == block:
            truth = count(held) if truth is None else truth.unionAll(count(held))
            held = []
    if held or truth is None:
        last = count(held)
        truth = last if truth is None else truth.unionAll(last)
    mine = result.where(F.col(id_col) % every == 0)
    zero = F.lit(0).cast("long")
    parts = [mine.select(F.lit(1).cast("long").alias("queries"), F.col("n_links").alias("links"), zero.alias("true_links")),
             truth.select(zero, zero, "t"),
             asked.select(zero, zero, -F.col("n"))]             # a row is no link of its own
    total = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return total.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in total.columns])
