"""Product dictionaries, mappings, catalogue and attribute metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import composite_key
from martloom.operators.clean import is_blank, require_nonblank, trim_all
from martloom.operators.sets import union_all
from martloom.operators.window import dedup, dedup_by_priority, surrogate
from martloom.sources.headers import apply_aliases

# Sheet headers of review-topic properties. Fixed values.
PROPERTY_ALIASES = {
    "類型": "type",
    "水準": "type",
    "尺度": "scale",
    "來源": "source",
    "準則": "note",
    "備註": "note",
}
PROPERTY_COLUMNS = ["product_line_id", "property_id", "property_name", "property_name_english", "definition", "type", "scale"]


def line_dictionary(profiles: DataFrame, item: str = "product_id", line: str = "product_line_id") -> DataFrame:
    """Distinct (item, line) pairs of the profiles of all lines, in one scan."""
    return profiles.select(item, F.col(line).alias("product_line_id")).distinct()


def product_mapping(sources: list[DataFrame]) -> DataFrame:
    """Union of (sku, item_id, product_line_id) sources, earlier ones winning, with a dense id."""
    ranked = [df.select("sku", "item_id", "product_line_id", F.lit(i).alias("source_rank")) for i, df in enumerate(sources, 1)]
    best = dedup_by_priority(union_all(*ranked), ["sku", "item_id"], "source_rank", ["product_line_id"])
    return surrogate(best, ["sku", "item_id"])


def catalogue(profiles: DataFrame) -> DataFrame:
    """Master keyed by (item, marketplace, line)."""
    rest = [c for c in profiles.columns if c not in ("item_id", "marketplace", "product_line_id")]
    return dedup(profiles, ["item_id", "marketplace", "product_line_id"], rest)


def property_dict(raw: DataFrame) -> DataFrame:
    """Topic properties: header aliases, English name falling back to the local one, one per (line, id)."""
    df = apply_aliases(raw, PROPERTY_ALIASES, PROPERTY_COLUMNS)
    named = require_nonblank(df, ["property_name"]).withColumn(
        "property_name_english", F.when(is_blank("property_name_english"), F.col("property_name")).otherwise(F.col("property_name_english"))
    )
    return dedup(named, ["product_line_id", "property_id"], ["property_name", "definition"])


ATTRIBUTE_COLUMNS = ["attribute_id", "name_zh", "name_en", "category", "scale_type"]


def attribute_meta(raw: DataFrame) -> DataFrame:
    """Attribute metadata with every expected column, blank ids dropped."""
    return require_nonblank(trim_all(apply_aliases(raw, {}, ATTRIBUTE_COLUMNS)), ["attribute_id"])


def lookup_keys(properties: DataFrame, load_date: str) -> DataFrame:
    return (
        properties.withColumn("property_lookup_key", composite_key(["product_line_id", "property_id"], "|"))
        .withColumn("product_property_key", composite_key(["product_id", "property_id"], "|"))
        .withColumn("temporal_key", composite_key(["property_id", load_date], "|"))
    )


def competitor_rank(items: DataFrame, sales: str = "sales") -> DataFrame:
    """Dense rank by sales inside the line, from the distinct sales values only."""
    from martloom.ordering import ranked

    values = items.groupBy("product_line_id", sales).agg(F.count(F.lit(1)).alias("_c")).drop("_c")
    placed = ranked(values, ["product_line_id"], [F.col(sales).desc()], "competitor_rank")
    return items.join(placed, ["product_line_id", sales])


def line_dim(raw: DataFrame, required: tuple[str, ...] = ("product_line_id", "name_en")) -> DataFrame:
    """Product-line dimension: trimmed headers, required columns present, extra columns kept."""
    df = raw.toDF(*[c.strip() for c in raw.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"product-line sheet lacks {missing}")
    return require_nonblank(trim_all(df), ["product_line_id"])
