"""Vector compression to short codes by exact integer k-means of vector parts.

Components become integers (scaled, floored), vectors are cut into equal parts,
and each part is replaced by the index of the nearest entry of its position's
codebook. All arithmetic is exact: |x - c|^2 = |x|^2 - 2 x.c + |c|^2, where the
dot products are matrix products of limbs. An integer is cut into limbs so
narrow that a float64 sum of limb products stays within 2^53, where float64
holds every integer; the limbs' products are put together again in int64. The
first of the smallest distances wins, so results do not depend on how rows fall
into batches. Blocks whose distances could leave int64 are computed with
integers of any length.

Spark reads the vectors once for each round and once for the codes. A round
leaves a task as sums and counts per codebook component, which are added up
before the driver gets them: its part is the codebooks, whose size the
parameters and the vectors' length set, never the rows.

Defined cases. Null vectors and vectors with a null, NaN or infinite component
are left out. Vectors shorter than the longest count as filled up with zeros,
as do lengths that the parts do not divide; empty vectors are all zeros. Null
ids come last in the order that the first entries are taken in, equal ids by
their vectors. With fewer vectors than entries the codebooks are that short. An
entry with no parts keeps its place. An
error beyond a long is null, and so is a sum over it. An empty
table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import cut

EXACT = 53              # bits of a float64's integers
ROWS = 4096             # vectors compared with a codebook at once
SUM_BITS = 60           # sums of any length travel as digits of so many bits
LONG = 1 << 63


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices with x = sum(limb[i] << (bits * i)); all but the last are not negative, none exceeds 2^bits."""
    out = []
    while x.size and (x.min() < -(1 << bits) or x.max() > 1 << bits):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dots(x: np.ndarray, c: np.ndarray, bits: int | None = None) -> np.ndarray:
    """The dot products of the rows of two int64 matrices, exact where they fit int64."""
    bits = bits or (EXACT - (max(x.shape[1], 1) - 1).bit_length()) // 2
    total = np.zeros((len(x), len(c)), dtype=np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first nearest row of c, and its squared distance. Integers (int64, or objects of any length)."""
    k = max(x.shape[1], 1)
    most = max([abs(int(v)) for a in (x, c) if a.size for v in (a.min(), a.max())], default=0)
    if 4 * k * most * most < LONG:
        x, c = x.astype(np.int64), c.astype(np.int64)
        far = (x * x).sum(axis=1)[:, None] - 2 * dots(x, c) + (c * c).sum(axis=1)[None, :]
        at = far.argmin(axis=1)
        return at, far[np.arange(len(x)), at]
    x, c = x.astype(object), c.astype(object)
    far = [[sum((a - b) ** 2 for a, b in zip(row, entry)) for entry in c] for row in x]
    at = [f.index(min(f)) for f in far]
    return np.array(at, dtype=np.int64), np.array([f[i] for f, i in zip(far, at)], dtype=object)


def integers(col: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column as rows of ``width``, filled up with zeros; ``scale`` is a power of two."""
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(col)), size)
    at = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    if len(values) and np.abs(values).max() >= LONG / (2 * scale):
        out = np.zeros((len(col), width), dtype=object)
        out[row, at] = [int(v) * scale if abs(v) >= 2.0 ** EXACT else int(np.floor(v * scale)) for v in values.tolist()]
        return out
    out = np.zeros((len(col), width), dtype=np.int64)
    out[row, at] = np.floor(values * scale).astype(np.int64)
    return out


@dataclass
class Codebooks:
    """``entries[p][e]``: the integers of entry e at part p; ``width``: the vectors' length with the zeros."""
    entries: list[list[list[int]]]
    width: int
    scale: int

    def matrices(self) -> list[np.ndarray]:
        out = []
        for entries in self.entries:
            fits = all(-LONG <= v < LONG for e in entries for v in e)
            out.append(np.array(entries, dtype=np.int64 if fits else object).reshape(len(entries), -1))
        return out

    def sha256(self) -> str:
        """Of all integers by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(str(v) for p in self.entries for e in p for v in e).encode()).hexdigest()


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def kept(vectors: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector is whole."""
    return vectors.where(F.col(vec_col).isNotNull() & F.forall(vec_col, _finite))


def _assigned(books: Codebooks):
    """(integers, chosen entries by part, distances by part) of runs of a column's vectors."""
    matrices = books.matrices()
    k = books.width // len(matrices)

    def run(col: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]:
        for i in range(0, len(col), ROWS):
            x = integers(col.slice(i, ROWS), books.width, books.scale)
            found = [nearest(x[:, p * k:(p + 1) * k], c) for p, c in enumerate(matrices)]
            yield x, [a for a, _ in found], [d for _, d in found]
    return run


def _improved(whole: DataFrame, vec_col: str, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floored mean of the parts nearest to it."""
    k = books.width // len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigned = _assigned(books)
        total = [[[0] * k for _ in p] for p in books.entries]
        count = [np.zeros(len(p), dtype=np.int64) for p in books.entries]
        for batch in batches:
            for x, at, _ in assigned(batch.column(0)):
                for p, a in enumerate(at):
                    count[p] += np.bincount(a, minlength=len(count[p]))
                    order = np.argsort(a, kind="stable")
                    used, first = np.unique(a[order], return_index=True)
                    part = x[order, p * k:(p + 1) * k]
                    wide = part.dtype == object or np.abs(part).max() >= LONG // (2 * ROWS)
                    for e, rows in zip(used.tolist(), np.split(part, first[1:])):
                        sums = rows.astype(object).sum(axis=0) if wide else rows.sum(axis=0)
                        total[p][e] = [s + int(v) for s, v in zip(total[p][e], sums)]
        out = []
        for p, entries in enumerate(total):
            for e, sums in enumerate(entries):
                for pos, s in enumerate(sums if count[p][e] else []):
                    digit, n = 0, int(count[p][e])
                    while not -(1 << 62) <= s < 1 << 62:
                        out.append((p, e, pos, digit, n, s & ((1 << SUM_BITS) - 1)))
                        s, digit = s >> SUM_BITS, digit + 1
                    out.append((p, e, pos, digit, n, s))
        names = ["p", "e", "pos", "digit", "n", "s"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(6)], names=names)

    parts = whole.select(vec_col).mapInArrow(run, "p long, e long, pos long, digit long, n long, s long")
    summed = (parts.groupBy("p", "e", "pos", "digit")
              .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")))
    total: dict[tuple[int, int, int], int] = {}
    count: dict[tuple[int, int, int], int] = {}
    for r in summed.collect():                              # a row for each component of the codebooks
        total[r.p, r.e, r.pos] = total.get((r.p, r.e, r.pos), 0) + (int(r.s) << (SUM_BITS * r.digit))
        if r.digit == 0:
            count[r.p, r.e, r.pos] = int(r.n)
    entries = [[[total[p, e, i] // count[p, e, i] if (p, e, i) in total else v for i, v in enumerate(entry)]
                for e, entry in enumerate(book)] for p, book in enumerate(books.entries)]
    return Codebooks(entries, books.width, books.scale)


def train(vectors: DataFrame, id_col: str, vec_col: str, parts: int = 16, entries: int = 64, rounds: int = 2,
          scale: int = 256) -> Codebooks | None:
    """The codebooks of all whole vectors, begun with the parts of the ``entries`` smallest ids; None without vectors.

    Runs ``rounds`` + 2 jobs. ``scale`` is a power of two; a code holds up to 256 entries.
    """
    whole = kept(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "v")
    longest = whole.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    k = max(1, -(-longest // parts))
    first = whole.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    x = integers(pa.array([list(r.v) for r in first], pa.list_(pa.float64())), k * parts, scale)
    books = Codebooks([[[int(v) for v in row[p * k:(p + 1) * k]] for row in x] for p in range(parts)], k * parts, scale)
    for _ in range(rounds):
        books = _improved(whole, "v", books)
    return books


def encode(vectors: DataFrame, vec_col: str, books: Codebooks) -> DataFrame:
    """The whole vectors' rows (their other columns) with ``code``, two hex digits for each part, and ``error``,
    the squared distance to what the code stands for."""
    others = [c for c in vectors.columns if c != vec_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigned = _assigned(books)
        for batch in batches:
            codes: list[str] = []
            errors: list[int | None] = []
            for _, at, far in assigned(batch.column(batch.num_columns - 1)):
                codes += [bytes(row).hex() for row in np.stack(at, axis=1).astype(np.uint8)]
                whole = [sum(int(d[i]) for d in far) for i in range(len(far[0]))]
                errors += [e if e < LONG else None for e in whole]
            cols = [*batch.columns[:-1], pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*[f"c{i}" for i in range(len(others))], "code", "error"])

    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]
    src = kept(vectors.select(*named, F.col(f"`{vec_col}`").alias("v")), "v")
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(src.schema.fields[:-1]))
    coded = src.mapInArrow(run, f"{kinds}, code string, error bigint" if others else "code string, error bigint")
    return coded.toDF(*others, "code", "error")


def with_group_error(coded: DataFrame, group: str, name: str) -> DataFrame:
    """Add the summed error of all rows of the same ``group`` value; nulls are one group.

    The rows are written once; sums are made where the rows lie, so a group of
    any size ships a row for each task.
    """
    coded = cut(coded, "vector-codes")
    whole = F.count("error") == F.count(F.lit(1))
    sums = (coded.groupBy(F.col(group).alias("__g")).agg(F.when(whole, F.sum(F.col("error").cast("decimal(20,0)"))).alias("__s"))
            .select("__g", F.expr("try_cast(__s as bigint)").alias(name)))
    return coded.join(sums, coded[group].eqNullSafe(sums["__g"])).drop("__g")
