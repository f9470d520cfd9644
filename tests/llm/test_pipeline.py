"""The pipeline's stages one by one on planted documents, and the registered names."""

from __future__ import annotations

import corpus_pipeline
from martloom.llm import registry


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_every_operator_has_one_query():
    registry.load()
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES


def test_stages_keep_clean_documents_and_columns(spark, data_dir):
    source = spark.read.parquet(f"{data_dir}/documents.parquet")
    item = spark.read.parquet(f"{data_dir}/benchmark.parquet").first().text
    planted = {
        900001: "A clean text. " + words("clean", 150),
        900002: "A clean text. " + words("clean", 150) + " tail",
        900003: words("before", 80) + " " + item + " " + words("after", 80),
        900004: "password = hunter2hunter2hunter2 and " + words("plain", 40),
        900005: None,
    }
    extra = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in planted.items()], source.schema)
    docs = source.unionByName(extra)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, data_dir)
        assert after.columns == source.columns
        docs = spark.createDataFrame(after.collect(), source.schema)
        kept[name] = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{data_dir}/labels.parquet").collect()}
    assert 900001 in kept["near copies"] and 900002 not in kept["near copies"]
    assert 900003 in kept["near copies"] and 900003 not in kept["benchmark leaks"]
    assert kept["secrets"][900004].text == "[secret] and " + words("plain", 40)
    assert kept["secrets"][900004].n_chars == len(kept["secrets"][900004].text)
    assert set(kept["secrets"]) == set(kept["benchmark leaks"])
    clean = [d for d, toxic in labels.items() if not toxic]
    assert sum(d in kept["toxicity"] for d in clean) >= 0.97 * len(clean)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir).collect()
    assert len(final) == docs.count() and all(r.lossless in (True, None) for r in final)


def test_empty_documents(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data_dir).count() == 0
