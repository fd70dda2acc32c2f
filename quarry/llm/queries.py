"""The registered queries of the operators, with their production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontam, embed_graph, line_dedup, merkle, mixing, pii, sharding, simhash, toxicity, url_cascade, vector_codes, warc
from quarry.session import scratch_path
from quarry.sources.tables import load

SHARDS = 16
MIN_SITES = 5
VOCABULARY = "byte_bpe_50k.json"
PII_KEY = b"registered query, not a secret"
# The rules, (verdict, host, path prefix).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Fixed value: hosts with one of these words as a label, or as a part of one between hyphens, are on the block list.
LISTED_HOST = r"(\A|[.-])(spam|casino|bets|adult)([.-]|(?![\s\S]))"


def q_op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by doc_id, with the shard under one more."""
    return sharding.shard_plan(load(spark, sf_dir, "documents"), [1.0] * SHARDS)


def q_op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a shared window of 10 benchmark words."""
    found = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def q_op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose SimHash fingerprints are joined by links of 4 bits or fewer."""
    groups = simhash.simhash_groups(load(spark, sf_dir, "documents"), shingle=4, radius=4)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def q_op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back; payload sizes and digests of responses are those of what was read."""
    path = scratch_path(spark, "warc")
    warc.write(warc.records(load(spark, sf_dir, "pages"), revisit_bytes=0), path)
    recs = warc.read(spark, path).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, r"\A<urn:page:(.*)>\z", 1).try_cast("bigint")
    response = F.col("record_type") == "response"
    digest = F.when(response, warc.sha1_base32(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", r"\Asha1:", ""))
    size = F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return recs.select(page(F.col("record_id")).alias("page_id"), size.alias("payload_bytes"),
                       digest.alias("payload_digest"), "record_type", page(F.col("refers_to")).alias("refers_to"))


def q_op5_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates (cosine 0.9) of all embeddings over the robust-pruned flat graph."""
    return embed_graph.near_duplicates(load(spark, sf_dir, "embeddings"), 0.9)


def q_op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are on 5 sources or more."""
    return line_dedup.remove_boilerplate(load(spark, sf_dir, "documents"), MIN_SITES)


def q_op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a Pfair mix of their sources, weighted by the square root of their rows."""
    docs = load(spark, sf_dir, "documents")
    return mixing.mix_plan(docs, mixing.target_weights(docs))


def q_op8_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the rules, else by the cascade over the block list's keys in the corpus."""
    judged = url_cascade.judge(load(spark, sf_dir, "pages"), RULES, lambda host, path: host.rlike(LISTED_HOST))
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def q_op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with format-preserving pseudonyms."""
    return pii.pseudonymised(load(spark, sf_dir, "documents"), PII_KEY)


def q_op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a factorization machine learnt from the labels that are not held out."""
    docs = load(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def q_op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of documents, with every document's proof and a check of a third of them after tampering."""
    docs = load(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf = lambda text: merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    rows = docs.select(merkle.group_key(F.col("lang")).alias("grp"), "doc_id", leaf(F.col("text")).alias("leaf"),
                       F.when(touched, leaf(lowered)).alias("tampered"))
    made = merkle.manifest(rows, ["doc_id"])
    root = F.lit(made.root).cast("string")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.proofs().select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
                                folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def q_op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents as tokens, and back."""
    import public_tokenizers

    vocab = bpe.vocabulary(spark, public_tokenizers.path(VOCABULARY))
    ids = bpe.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", vocab)
    digests = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "ids")
    back = bpe.decode(digests, "ids", vocab)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def q_op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole embeddings as codes of 16 parts over codebooks of 64 entries, with their errors."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = vector_codes.train(vectors, "vec_id", "embedding")
    out = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = vector_codes.with_group_error(vector_codes.encode(vectors, "embedding", books), "label", "label_error")
    return coded.withColumn("codebooks_sha256", F.lit(books.sha256())).select(*out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": q_op1_sharding,
    "op2_decontamination": q_op2_decontamination,
    "op3_simhash": q_op3_simhash,
    "op4_warc": q_op4_warc,
    "op5_embedding_graph": q_op5_embedding_graph,
    "op6_line_dedup": q_op6_line_dedup,
    "op7_mixing": q_op7_mixing,
    "op8_url_cascade": q_op8_url_cascade,
    "op9_pii": q_op9_pii,
    "op10_toxicity": q_op10_toxicity,
    "op11_merkle": q_op11_merkle,
    "op12_bpe": q_op12_bpe,
    "op13_vector_codes": q_op13_vector_codes,
}
