"""The training-data pipeline over ``documents``: each stage works on all rows its predecessor kept.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame; all but the last
return the columns of documents. ``run`` writes each stage's rows to the shared
checkpoint folder and reads them again for the next. Two stages have no SQL
form (a learnt model, covering LSH with components), so ``ORACLE_SQL`` is None
and the tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontam, mixing, sharding, simhash, toxicity
from quarry.llm.tables import cut
from quarry.sources.tables import load

SHARDS = 16


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.3 or more go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (4-word shingles, 4 bits) the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share 10 consecutive words with a benchmark item go."""
    return decontam.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the Pfair order of their sources (weights: square root of the rows); files in name order hold it."""
    return mixing.mixed(docs, mixing.target_weights(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard of 16 by rendezvous hashing of its id, and its place (position, in_block) in the mix.

    Rows that were written and read again have no order, so the place, which
    the documents and their sources alone decide, is a column of the result.
    """
    placed = mixing.with_place(docs, mixing.target_weights(docs))
    return sharding.with_shard(placed, ["doc_id"], [1.0] * SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents; runs jobs.

    The columns of documents, each document's place in the mix (``position`` of
    its block, ``in_block``) and its shard: whoever writes the rows has the
    mixed order, over all and in each shard, in columns.
    """
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
