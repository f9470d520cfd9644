"""Benchmark items that passages of each document retrieve, and those that leaked into it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.decontaminate import leaks
from martloom.llm.registry import query
from martloom.llm.tables import table

THRESHOLD, OVERLAP = 0.6, 0.8


@query("op8_bm25_leaks")
def bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks(docs, "text", table(spark, sf_dir, "benchmark"), THRESHOLD, OVERLAP)
    return found.select("doc_id", F.size("leaked").cast("long").alias("n_items"), "leaked", "retrieved", (F.size("leaked") > 0).alias("contaminated"))
