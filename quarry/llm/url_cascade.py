"""URL filters: longest-prefix rules, and exact list membership by a Bloom filter cascade.

The first level of a cascade encodes the listed keys; the next one encodes the
unlisted keys of the corpus that the first lets through, the one after that
the listed keys which that one lets through, and so on until a level lets
nothing wrong through. Over the complete key universe of the corpus the
answers are exact, and pages are judged in their scan without a join.

Keys are dealt to shards by hash, and each shard's cascade is built in one
task from a bounded number of keys, so building needs one shuffle of distinct
keys. Cascades are broadcast in blocks of bounded size, of which a task holds
one at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import cut
from quarry.llm.words import mix

SHARD_KEYS = 100_000            # distinct keys of one cascade, about
BLOCK_BYTES = 16 << 20          # cascades in one broadcast block
LEVELS = 64                     # a cascade halves at every level; more levels mean equal hashes


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule ``(verdict, host, path)`` that fits, else nulls.

    A rule fits its host and all subdomains when the url's path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):      # the last one wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, m: int, k: int) -> Iterator[np.ndarray]:
    a = mix(h1 ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    b = mix(h2 + np.uint64(level)) | np.uint64(1)
    for j in range(k):
        yield (mix(a + np.uint64(j) * b) % np.uint64(m)).astype(np.int64)


def _in_level(bits: np.ndarray, m: int, k: int, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    inside = np.ones(len(h1), dtype=bool)
    for at in _positions(h1, h2, level, m, k):
        inside &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return inside


def build(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """The levels ``(bits, hashes, filter)`` that answer exactly for these distinct keys."""
    take, rest = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[tuple[int, int, bytes]] = []
    while len(take):
        if len(levels) == LEVELS:
            raise ValueError("a listed and an unlisted key have equal hashes")
        # the first level lets through about as many unlisted keys as there are listed ones
        p = min(0.5, len(take) * math.sqrt(0.5) / max(1, len(rest))) if not levels else 0.5
        m = max(8, math.ceil(len(take) * -math.log(p) / math.log(2) ** 2))
        k = max(1, round(m / len(take) * math.log(2)))
        bits = np.zeros((m + 7) // 8, dtype=np.uint8)
        for at in _positions(h1[take], h2[take], len(levels), m, k):
            np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        levels.append((m, k, bits.tobytes()))
        wrong = rest[_in_level(bits, m, k, len(levels) - 1, h1[rest], h2[rest])]
        take, rest = wrong, take
    return levels


def contains(levels: list[tuple[int, int, bytes]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Listed or not, for keys of the universe the cascade was built over."""
    out = np.zeros(len(h1), dtype=bool)
    open_ = np.arange(len(h1))
    for n, (m, k, raw) in enumerate(levels):
        inside = _in_level(np.frombuffer(raw, dtype=np.uint8), m, k, n, h1[open_], h2[open_])
        out[open_[~inside]] = n % 2 == 1            # an even level encodes unlisted keys: outside it means listed
        open_ = open_[inside]
    out[open_] = len(levels) % 2 == 1
    return out


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def cascade(universe: DataFrame, key_col: str, listed_col: str, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(shard, shards, keys, listed, levels)`` over the distinct keys of ``universe``; null keys are left out.

    A key that any row lists is listed. Runs a job (the distinct keys are written once).
    """
    keys = (universe.select(F.col(key_col).alias("key"), F.col(listed_col).cast("boolean").alias("on")).where("key is not null")
            .groupBy("key").agg(F.coalesce(F.max("on"), F.lit(False)).alias("on")))
    h1, h2 = _hashes(F.col("key"))
    keys = cut(keys.select(h1.alias("h1"), h2.alias("h2"), "on"), "cascade-keys")
    shards = max(1, math.ceil(keys.count() / shard_keys))

    def one(table: pa.Table) -> pa.Table:
        on = table.column("on").to_numpy()
        levels = build(table.column("h1").to_numpy().view(np.uint64), table.column("h2").to_numpy().view(np.uint64), on)
        kind = pa.list_(pa.struct([("m", pa.int64()), ("k", pa.int32()), ("bits", pa.binary())]))
        rows = [{"m": m, "k": k, "bits": raw} for m, k, raw in levels]
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                         "shards": pa.array([shards], pa.int64()), "keys": pa.array([len(on)], pa.int64()),
                         "listed": pa.array([int(on.sum())], pa.int64()), "levels": pa.array([rows], kind)})

    return (keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
            .groupBy("shard").applyInArrow(one, "shard bigint, shards bigint, keys bigint, listed bigint, "
                                                "levels array<struct<m:bigint,k:int,bits:binary>>"))


def member(built: DataFrame, block_bytes: int = BLOCK_BYTES) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of two hash columns for use in tasks; the driver holds one block of cascades at a time."""
    sc = built.sparkSession.sparkContext
    parts, block, size, shards = [], {}, 0, 1
    for r in built.toLocalIterator():
        levels = [(x["m"], x["k"], bytes(x["bits"])) for x in r["levels"]]
        n = sum(len(x[2]) for x in levels)
        if block and size + n > block_bytes:
            parts.append(sc.broadcast(block))
            block, size = {}, 0
        block[r["shard"]], size, shards = levels, size + n, r["shards"]
    if block:
        parts.append(sc.broadcast(block))

    def listed(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        shard = (h1 % shards).astype(np.int64)      # signed, as pmod
        out = np.zeros(len(h1), dtype=bool)
        for part in parts:
            held = part.load_from_path(part._path) if len(parts) > 1 else part.value
            for s in np.unique(shard).tolist():
                if s in held:
                    at = np.flatnonzero(shard == s)
                    out[at] = contains(held[s], h1[at].view(np.uint64), h2[at].view(np.uint64))
        return out

    return listed


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: Callable[[Column, Column], Column],
          id_col: str = "page_id", url_col: str = "url", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, listed.

    ``listed(host, path)`` marks the block list's keys in the corpus; the keys
    host + path of all pages are the universe. The longest rule that fits
    decides; without one, a listed key is blocked and any other allowed. Null
    urls and urls without ``://`` have an empty host and path (a key like any
    other). Repeated rows come back repeated, an empty table gives no rows,
    other columns are not read.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    universe = split.select(F.concat("host", "path").alias("key"), listed(F.col("host"), F.col("path")).alias("on"))
    is_listed = member(cascade(universe, "key", "on", shard_keys))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    h1, h2 = _hashes(F.concat("host", "path"))
    ready = split.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), h1.alias("h1"), h2.alias("h2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = is_listed(batch.column(5).to_numpy(zero_copy_only=False), batch.column(6).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(on)],
                                             names=["id", "host", "path", "rule", "verdict", "listed"])

    kind = ready.schema["id"].dataType.simpleString()
    out = ready.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string, listed boolean")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
