"""Rendezvous hashing of record keys over weighted shards (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.numbering import number_within, text_key

HEX_DIGITS = 13         # 52 bits of the md5 digest, exact in a double


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) of a text key.

    Every shard draws a number from the key and its own index alone, and the
    largest ``weight / -ln(draw)`` wins, so a shard's share follows its weight
    and a key moves only to a shard that is new or heavier (or off one that
    went or got lighter). Shards of weight 0 get nothing. Ties go to the lower
    index. A null key is a key of its own.
    """
    if not weights or any(w < 0 for w in weights) or not any(w > 0 for w in weights):
        raise ValueError("weights need a positive entry and no negative one")
    safe = F.coalesce(key, F.lit("\\N"))
    draws = []
    for i, w in enumerate(weights):
        if w == 0:
            continue
        digest = F.substring(F.md5(F.concat(safe, F.lit(f"#{i}"))), 1, HEX_DIGITS)
        u = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << (4 * HEX_DIGITS))
        draws.append(F.struct((F.lit(float(w)) / -F.log(u)).alias("score"), F.lit(-i).alias("neg")))
    best = draws[0] if len(draws) == 1 else F.greatest(*draws)
    return (-best["neg"]).cast("int")


def with_shard(df: DataFrame, key_cols: Sequence[str], weights: Sequence[float],
               name: str = "shard") -> DataFrame:
    """``df`` with its shard; a column of that name is replaced."""
    return df.withColumn(name, rendezvous(text_key(*[F.col(f"`{c}`") for c in key_cols]), weights))


def shard_plan(docs: DataFrame, weights: Sequence[float], grown_weights: Sequence[float] | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the weights alone decide the shard (law ``key``). ``size`` is
    the text's UTF-8 bytes plus 1, ``slot`` numbers a shard's rows from 0
    without gaps, ``grown_shard`` is the shard under ``grown_weights`` (one
    more shard of weight 1 unless given). Null texts have size 1 and a null
    checksum of the empty text (0); null ids share one shard; repeated rows
    get a slot each; empty tables give no rows; other columns are not read.
    """
    grown = list(grown_weights) if grown_weights is not None else [*weights, 1.0]
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    digest = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(text_key(F.col(id_col)), weights).alias("shard"),
        rendezvous(text_key(F.col(id_col)), grown).alias("grown_shard"))
    out = number_within(digest, "shard", [id_col, "size", "text_crc32"], "slot")
    return out.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
