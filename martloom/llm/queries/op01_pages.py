"""Main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.page_text import extracted
from martloom.llm.registry import query
from martloom.llm.tables import table


@query("op1_line_blocks")
def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages, "html").withColumn("n_chars", F.length("text").cast("long"))
