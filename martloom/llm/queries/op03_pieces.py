"""Every document as piece ids with merge-dropout, decoded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.pieces import encoded
from martloom.llm.registry import query
from martloom.llm.tables import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 7


@query("op3_dropout_pieces")
def dropout_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and whether they decode to the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encoded(docs, "doc_id", "text", MODEL, DROPOUT, SEED)
    return found.select("doc_id", F.array_size("ids").cast("long").alias("n_pieces"), "ids", "lossless")
