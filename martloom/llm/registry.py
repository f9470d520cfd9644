"""Queries of this subpackage with their independent SQL (None: compared with brute force in tests)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

MODULES = [
    "op01_pages",
    "op02_secrets",
    "op03_pieces",
    "op04_urls",
    "op05_nearest",
    "op06_shards",
    "op07_toxicity",
    "op08_benchmark",
    "op09_chat",
    "op10_simhash",
    "op11_licenses",
    "op12_manifest",
    "op13_repair",
]


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql:
            SQL[name] = sql
        return plan

    return add


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"martloom.llm.queries.{name}")
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
