"""Fingerprints of all documents and the component of near copies each belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.registry import query
from martloom.llm.simhash import near_copies
from martloom.llm.tables import table


@query("op10_gray_simhash")
def gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"), "doc_id", "text")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
