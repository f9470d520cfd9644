"""Paged order documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import jsonify
from martloom.operators.reshape import explode_items


def split_orders(documents: DataFrame, items: str = "line_items") -> tuple[DataFrame, DataFrame]:
    """Header table (nested leftovers as JSON text) and exploded item table."""
    header = jsonify(documents.drop(items))
    return header, explode_items(documents.select("order_id", items), items)


def parse_orders(raw: DataFrame, schema: str, col: str = "body") -> DataFrame:
    """Order documents from JSON text with a declared schema."""
    return raw.select(F.from_json(col, schema).alias("o")).select("o.*")
