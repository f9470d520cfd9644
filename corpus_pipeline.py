"""A training corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.decontaminate import leaks
from martloom.llm.pieces import encoded
from martloom.llm.queries import op02_secrets, op03_pieces, op07_toxicity, op08_benchmark
from martloom.llm.secret_scan import redacted, scan_unseen, with_findings
from martloom.llm.simhash import one_of_each
from martloom.llm.tables import table
from martloom.llm.toxicity import fit_chain, scored
from martloom.session import materialise


def _columns(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select([F.col(f"`{c}`") for c in like.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labelled ones among them, doesn't find toxic."""
    q = op07_toxicity
    chain = fit_chain(docs, "text", table(spark, sf_dir, "labels"), "doc_id", q.CATEGORIES, q.SAMPLE, q.TERMS)
    return _columns(scored(docs, "text", chain, "_p_").filter(F.col("_p_toxic") < q.THRESHOLD), docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return one_of_each(docs, "doc_id", "text")


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaked."""
    q = op08_benchmark
    marked = leaks(docs.withColumnsRenamed({"leaked": "_own_leaked", "retrieved": "_own_retrieved"}), "text", table(spark, sf_dir, "benchmark"), q.THRESHOLD, q.OVERLAP)
    clean = marked.filter(F.size("leaked") == 0).drop("leaked", "retrieved")
    return _columns(clean.withColumnsRenamed({"_own_leaked": "leaked", "_own_retrieved": "retrieved"}), docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars follows the new text."""
    rules = op02_secrets.BASE_RULES
    ledger = materialise(scan_unseen(docs, "text", rules), "ledger")
    found = with_findings(docs.withColumnRenamed("secrets", "_own_secrets"), "text", rules, ledger)
    clean = found.withColumn("text", redacted(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = F.size("secrets") > 0
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return _columns(clean.drop("secrets").withColumnRenamed("_own_secrets", "secrets"), docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids and whether they decode to the text again."""
    q = op03_pieces
    ids = encoded(docs.select("doc_id", "text"), "doc_id", "text", q.MODEL, q.DROPOUT, q.SEED)
    return ids.select("doc_id", F.array_size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_copies),
    ("benchmark leaks", without_leaks),
    ("secrets", without_secrets),
    ("pieces", as_pieces),
]

# classifier, fingerprints and pieces have no SQL form; tests follow planted documents through the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
