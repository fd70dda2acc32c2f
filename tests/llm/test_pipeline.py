from __future__ import annotations

from collections import Counter

from awkward import AWKWARD, docs
from pyspark.sql import functions as F
from test_decontam import brute as brute_contamination
from test_sharding_mixing import brute_shard
from test_simhash import brute_groups

import __spark_entry__
import corpus_pipeline
from quarry.llm import mixing, toxicity
from quarry.sources.tables import load

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_run_by_brute_force(spark):
    d = load(spark, MIDDLE, "documents")
    model = toxicity.train(d, load(spark, MIDDLE, "labels"))
    toxic = {r["doc_id"] for r in toxicity.toxicity_scores(d, model).where("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"]) for r in d.collect() if r["doc_id"] not in toxic]
    first = {i for i, _, c in brute_groups(rows) if i == c}
    rows = [r for r in rows if r[0] in first]
    items = [(r["item_id"], r["text"]) for r in load(spark, MIDDLE, "benchmark").collect()]
    clean = {i for i, _, hit, _ in brute_contamination(rows, items) if not hit}
    got = corpus_pipeline.run(spark, MIDDLE)
    assert got.columns == [*d.columns, "position", "in_block", "shard"]
    assert Counter((r["doc_id"], r["shard"]) for r in got.collect()) == Counter((i, brute_shard(i, [1] * 16)) for i in clean)
    assert toxic and len(first) < d.count() and len(clean) < len(first)


def test_stages_take_awkward_documents(spark):
    d = docs(spark, AWKWARD, source=lambda k: None if k % 4 == 0 else f"s{k % 3}").drop("shard")
    for empty in (False, True):
        rows = d.limit(0) if empty else d
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SMALL)
            assert out.columns[:len(d.columns)] == d.columns, name
            rows = spark.createDataFrame(out.collect(), out.schema).select(*d.columns) if not empty else out.limit(0).select(*d.columns)
        kept = sorted(str(r["doc_id"]) for r in rows.collect())
        assert kept == ([] if empty else ["1", "10", "12", "4", "6", "7", "9", "None", "None"])


def test_the_mix_reaches_the_result(spark):
    got = {r["doc_id"]: (r["position"], r["in_block"]) for r in corpus_pipeline.run(spark, MIDDLE).collect()}
    d = load(spark, MIDDLE, "documents")
    kept = d.where(d["doc_id"].isin(list(got))).repartition(5)
    plan = mixing.mix_plan(kept, mixing.target_weights(kept)).collect()
    assert got == {r["doc_id"]: (r["position"], r["in_block"]) for r in plan} and len(got) == len(plan)


def test_last_stages_take_clashing_names(spark):
    d = load(spark, SMALL, "documents").withColumns({c: F.lit(1) for c in ("__at", "__src", "a.b", "id", "src", "i", "n")})
    for name, stage in corpus_pipeline.STAGES[3:]:
        out = stage(spark, d, SMALL)
        assert out.columns[:len(d.columns)] == d.columns and out.count() == d.count(), name


def test_registered():
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
