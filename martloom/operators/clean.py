"""Projection, filtering and invalidation of raw columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINELS = ["unclassified", "UNKNOWN"]


def is_blank(c: Column | str) -> Column:
    """Null and whitespace-only are the same thing for keys."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | (F.length(F.trim(col.cast("string"))) == 0)


def first_present(df: DataFrame, out: str, candidates: list[str]) -> DataFrame:
    """The first existing candidate becomes `out`; no candidate at all is an error."""
    for name in candidates:
        if name in df.columns:
            return df.withColumn(out, F.col(name))
    raise ValueError(f"none of {candidates} present for {out}")


def with_lineage(df: DataFrame, platform: str, version: str, phase: str) -> DataFrame:
    defaults = {"platform_id": F.lit(platform), "product_line_id": F.lit(None).cast("string")}
    new = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(
        {**new, "standardization_timestamp": F.current_timestamp(), "standardization_version": F.lit(version), "etl_phase": F.lit(phase)}
    )


def derive_money(df: DataFrame) -> DataFrame:
    """Fill unit price, line total and discount from quantity, price and discounted price; cents are exact."""
    qty, price, paid = F.col("quantity"), F.col("unit_price"), F.col("discounted_price")
    unit = F.coalesce(price, F.when(qty > 0, paid / qty))
    cents = lambda c: F.round(c.cast("decimal(28,6)"), 2).cast("double")
    return df.withColumns(
        {
            "unit_price": cents(unit),
            "line_total": cents(F.coalesce(paid, qty * unit)),
            "discount": cents(F.greatest(F.coalesce(qty * unit - paid, F.lit(0.0)), F.lit(0.0))),
        }
    )


def derive_margin(df: DataFrame, rate: float = 0.10) -> DataFrame:
    """Gross, commission, fee, profit and guarded margin percentage of a marketplace line."""
    gross = F.col("quantity") * F.col("transaction_price")
    price = F.col("transaction_price")
    return df.withColumns(
        {
            "gross_revenue": gross,
            "net_revenue": gross * (1 - rate),
            "marketplace_fee": gross * 0.10,
            "net_profit": gross * (1 - rate) - gross * 0.10,
            "profit_margin": F.when(price > 0, (price - F.col("unit_price") * 0.7) / price * 100).otherwise(0.0),
            "fulfilment_class": F.when(F.col("shipping_fee") > 0, "SELLER_FULFILLED").otherwise("FREE_SHIPPING"),
        }
    )


def front(df: DataFrame, cols: list[str]) -> DataFrame:
    lead = [c for c in cols if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def select_any(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_all(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in string_columns(df)})


def blank_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Blank and the text NA become null."""
    missing = lambda c: is_blank(c) | (F.trim(c) == "NA")
    return df.withColumns({c: F.when(~missing(c), F.col(c)) for c in cols or string_columns(df)})


def to_number(c: Column, strip: bool = False) -> Column:
    """Number or null; `strip` removes everything but digits and dots first."""
    return (F.regexp_replace(c, r"[^0-9.]", "") if strip else c).try_cast("double")


def to_flag(c: Column, default: bool = False) -> Column:
    return F.coalesce(c.try_cast("boolean"), F.lit(default))


def require_nonblank(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in cols:
        df = df.filter(~is_blank(c))
    return df


def null_if(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Invalid values become null and the row stays: {column: predicate that marks it invalid}."""
    return df.withColumns({c: F.when(~F.coalesce(bad, F.lit(False)), F.col(c)) for c, bad in rules.items()})


EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
ASIN = r"^[A-Z0-9]{10}$"
ITEM_CODE = r"^[A-Za-z0-9]{8,}$"


def keep_matching(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).rlike(pattern))


def drop_test_orders(df: DataFrame, col: str = "order_number") -> DataFrame:
    return df.filter(~F.col(col).rlike("(?i)TEST|DEMO"))


def keep_active(df: DataFrame, lines: DataFrame, on: str = "product_line_id") -> DataFrame:
    """Semi join on the active lines of the dimension."""
    return df.join(lines.filter("is_active").select(on), on, "left_semi")


def drop_sentinels(df: DataFrame, col: str = "product_line_id", sentinels: list[str] = SENTINELS) -> DataFrame:
    return df.filter(~is_blank(col) & ~F.trim(col).isin(sentinels))


# Texts that mark a failed result. Fixed values.
ERROR_MARKS = ["Connection_error", "timeout", "rate_limit"]


def error_rows(df: DataFrame, col: str, marks: list[str] = ERROR_MARKS) -> DataFrame:
    hit = F.lit(False)
    for mark in marks:
        hit = hit | F.col(col).like(f"%{mark}%")
    return df.filter(hit)


def shipped(df: DataFrame, col: str = "order_status") -> DataFrame:
    return df.filter(F.col(col).isin("shipped", "delivered"))


def backfill_id(df: DataFrame, item: str, sku: str, source: str, row_id: str) -> tuple[DataFrame, DataFrame]:
    """Replace a missing item id by a SKU that has the shape of one; second frame lists the rows touched."""
    missing = is_blank(item) | (F.col(item) == "UNKNOWN_PRODUCT")
    usable = missing & F.coalesce(F.col(sku).rlike(ASIN), F.lit(False))
    audit = df.filter(usable).select(
        F.lit(source).alias("source_table"), F.col(row_id).cast("string").alias("source_row_id"), F.lit("sku_used_as_item_id").alias("reason")
    )
    return df.withColumn(item, F.when(usable, F.col(sku)).otherwise(F.col(item))), audit
