"""Every document with the chain's probabilities and whether it counts as toxic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.registry import query
from martloom.llm.tables import table
from martloom.llm.toxicity import fit_chain, scored

# the label table has two judgements; low quality comes first in the chain
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
SAMPLE, TERMS, THRESHOLD = 20_000, 4096, 0.2


def judged(spark: SparkSession, docs: DataFrame, sf_dir: str, training: DataFrame | None = None) -> DataFrame:
    """`docs` with p_low_quality, p_toxic and toxic; the chain is fitted on `training` (default: documents)."""
    source = table(spark, sf_dir, "documents") if training is None else training
    chain = fit_chain(source, "text", table(spark, sf_dir, "labels"), "doc_id", CATEGORIES, SAMPLE, TERMS)
    return scored(docs, "text", chain).withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


@query("op7_chained_toxicity")
def chained_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(spark, docs, sf_dir).select("doc_id", "p_low_quality", "p_toxic", "toxic")
