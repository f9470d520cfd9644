"""Text normalisation, value maps, names and codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.clean import EMAIL, is_blank, string_columns

# Localised order states and payment methods. Fixed values.
ORDER_STATUS = {
    "待處理": "pending",
    "處理中": "processing",
    "已出貨": "shipped",
    "已送達": "delivered",
    "已完成": "delivered",
    "已取消": "cancelled",
    "已退款": "refunded",
    "退貨": "refunded",
}
PAYMENT_METHOD = {"信用卡": "credit_card", "轉帳": "bank_transfer", "貨到付款": "cash_on_delivery", "PayPal": "paypal"}

# Scale codes of review topics. Fixed values.
SCALES = {"2": "2尺度", "2尺度": "2尺度", "5": "5尺度", "5尺度": "5尺度"}
DEFAULT_SCALE = "5尺度"


def norm_text(c: Column, mode: str) -> Column:
    """Modes: lower, upper, trim, squash (no whitespace at all)."""
    trimmed = F.trim(c)
    return {
        "lower": F.lower(trimmed),
        "upper": F.upper(trimmed),
        "trim": trimmed,
        "squash": F.regexp_replace(c, r"\s+", ""),
    }[mode]


def email_domain(c: Column) -> Column:
    return F.when(c.contains("@"), F.lower(F.regexp_replace(F.trim(c), ".*@", "")))


def valid_email(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike(EMAIL), F.lit(False))


def map_values(c: Column, mapping: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), default)


def order_status(c: Column) -> Column:
    """Known local states become codes; others are lowered and trimmed."""
    return map_values(c, ORDER_STATUS, F.lower(F.trim(c)))


def payment_method(c: Column) -> Column:
    return map_values(c, PAYMENT_METHOD, F.lit("other"))


def canon_name(c: Column) -> Column:
    """Trimmed lower-case name with every run of other signs as one underscore."""
    return F.lower(F.regexp_replace(F.trim(c), r"[^\p{L}\p{N}]+", "_"))


def norm_scale(c: Column) -> Column:
    """Scale code; blank means five levels, unknown codes stay visible as they are."""
    code = F.trim(c)
    return F.when(is_blank(c), F.lit(DEFAULT_SCALE)).otherwise(map_values(code, SCALES, code))


def unknown_scales(df: DataFrame, col: str) -> DataFrame:
    return df.select(norm_scale(F.col(col)).alias("scale")).filter(~F.col("scale").isin(list(SCALES.values()))).groupBy("scale").count().withColumnRenamed("count", "n")


CONTROL = r"[\x00-\x1F\x7F]"
SUSPECT = r"[\x00-\x1F�─-╿]|[Ѐ-ӿ][A-Za-z]|[A-Za-z][Ѐ-ӿ]"


def clean_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Control characters go; what is then empty becomes null."""
    strip = lambda c: F.nullif(F.trim(F.regexp_replace(c, CONTROL, "")), F.lit(""))
    return df.withColumns({c: strip(F.col(c)) for c in cols or string_columns(df)})


def mojibake_audit(df: DataFrame) -> DataFrame:
    """Per string column: rows that look wrongly encoded and the smallest such value; one pass."""
    cols = string_columns(df)
    hit = {c: F.col(c).rlike(SUSPECT) for c in cols}
    one = df.agg(
        *[F.count_if(hit[c]).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.min(F.when(hit[c], F.col(c))).alias(f"s_{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("n_suspect"), F.col(f"s_{i}").alias("sample_value")) for i, c in enumerate(cols)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


# Prefixes of one-hot predictor names that reveal their source attribute. Fixed values.
DUMMY_SOURCES = ["brand", "color", "material", "category", "design", "style", "size", "type", "model", "manufacturer"]


def source_variable(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?i)^(" + "|".join(DUMMY_SOURCES) + ")_", 1), F.lit(""))


def data_type(term: Column, is_binary: Column) -> Column:
    return F.when(source_variable(term).isNotNull(), "dummy").when(F.coalesce(is_binary, F.lit(False)), "binary").otherwise("numerical")


def predictor_pattern(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def composite_key(cols: list[str], sep: str = "||") -> Column:
    """Joined key in which a null part keeps its place."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def identity_key(df: DataFrame) -> Column:
    """Best available buyer identity: postal address, then place, buyer id, order id.

    A rung applies only if all its columns exist and the deciding ones are not blank.
    """
    has = lambda *cols: all(c in df.columns for c in cols)
    text = lambda c: F.coalesce(F.lower(F.trim(F.col(c).cast("string"))), F.lit("NA"))
    filled = lambda *cols: reduce(lambda a, b: a & b, [~is_blank(c) for c in cols])
    place = ["ship_city", "ship_state", "ship_country"]
    rungs = []
    if has("ship_postal_code", *place):
        rungs.append(F.when(filled("ship_postal_code"), F.concat_ws("::", F.lit("postal"), *[text(c) for c in ["ship_postal_code", *place]])))
    if has(*place):
        rungs.append(F.when(filled(*place), F.concat_ws("::", F.lit("geo"), *[text(c) for c in place])))
    elif has("ship_state", "ship_country"):
        rungs.append(F.when(filled("ship_state", "ship_country"), F.concat_ws("::", F.lit("state"), text("ship_state"), text("ship_country"))))
    if has("buyer_identification_number"):
        rungs.append(F.when(filled("buyer_identification_number"), F.concat_ws("::", F.lit("bid"), text("buyer_identification_number"))))
    if has("order_id"):
        rungs.append(F.when(filled("order_id"), F.concat_ws("::", F.lit("order"), text("order_id"))))
    return F.coalesce(*rungs)


def jsonify(df: DataFrame) -> DataFrame:
    """Array, struct and map columns become `{name}_json` text."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
    return df.withColumns({f"{c}_json": F.to_json(c) for c in nested}).drop(*nested)


def fingerprint(df: DataFrame, cell: list[str], cols: list[str]) -> DataFrame:
    """One hash per cell over its rows, independent of row order.

    Row digests are added up in four lanes, so the hash merges partially on every task and no
    cell is ever gathered in one place.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"}), 256)
    lanes = [F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    return df.groupBy(*cell).agg(
        F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *[lane.cast("string") for lane in lanes]), 256).alias("fingerprint")
    )


def quality_tier(df: DataFrame) -> DataFrame:
    """Score 100/85/70/50/30 by which review fields are filled."""
    has = lambda *cols: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    core = ["product_id", "product_line_id", "platform_id"]
    return df.withColumn(
        "final_quality_score",
        F.when(has(*core, "rating", "review_date", "review_text"), 100)
        .when(has(*core, "rating", "review_date"), 85)
        .when(has(*core, "rating"), 70)
        .when(has(*core), 50)
        .otherwise(30),
    )
