"""Time and attribute labels of model predictors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import WEEKDAYS, period_bounds
from martloom.operators.window import with_display_order

# Labels shown for weekday predictors. Fixed values.
WEEKDAY_LABELS = {
    "monday": "週一",
    "tuesday": "週二",
    "wednesday": "週三",
    "thursday": "週四",
    "friday": "週五",
    "saturday": "週六",
    "sunday": "週日",
}
DAY_LABEL = "每月日期效應"


def time_labels(df: DataFrame, year: int) -> DataFrame:
    """Split predictor names into year/month/quarter, hierarchy, granularity and display labels."""
    p = F.col("predictor")
    is_year, is_day, is_weekday = p == "year", p == "day", p.isin(WEEKDAYS)
    is_month = p.rlike("^month_")
    y = F.lit(year)
    out = df.withColumns(
        {
            "analysis_year": F.when(is_year | is_month, y),
            "analysis_month": F.nullif(F.regexp_extract(p, r"^month_(\d+)$", 1), F.lit("")).cast("int"),
            "time_hierarchy": F.when(is_year, "year").when(is_month, "month").when(is_day, "day").when(is_weekday, "weekday").otherwise("other"),
            "time_granularity": F.when(is_year, "yearly").when(is_month, "monthly").when(is_day, "daily").when(is_weekday, "weekly"),
        }
    ).withColumn("analysis_quarter", F.ceil(F.col("analysis_month") / 3).cast("int"))
    weekday = F.try_element_at(F.create_map(*[F.lit(x) for kv in WEEKDAY_LABELS.items() for x in kv]), p)
    return out.withColumns(
        {
            "year_label": F.when(is_year, F.concat(y.cast("string"), F.lit("年"))),
            "month_label": F.when(is_month, F.concat(y.cast("string"), F.lit("年"), F.col("analysis_month").cast("string"), F.lit("月"))),
            "quarter_label": F.when(F.col("analysis_quarter").isNotNull(), F.concat(y.cast("string"), F.lit("年Q"), F.col("analysis_quarter").cast("string"))),
            "week_label": weekday,
            "day_label": F.when(is_day, DAY_LABEL),
        }
    )


def label_coefficients(coefficients: DataFrame, year: int) -> DataFrame:
    """Time labels, period bounds and display order for model coefficients."""
    labelled = time_labels(coefficients, year)
    bounds = period_bounds(labelled.withColumn("_y", F.col("analysis_year")), "_y", "analysis_month").drop("_y")
    dated = F.col("analysis_year").isNotNull()
    kept = {c: F.when(dated, F.col(c)) for c in ("date_start", "date_end", "period_days")}
    return with_display_order(bounds.withColumns(kept))


# Predictor names that come from the calendar. Fixed values.
CALENDAR = ["year", "day", *[f"month_{m}" for m in range(1, 13)], *WEEKDAYS]


def classify_predictor(df: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Type from the metadata table, else calendar name, else rating suffix, else product attribute."""
    p = F.col("predictor")
    rule: Column = F.when(p.isin(CALENDAR), "time_feature").when(p.endswith("_rating"), "comment_attribute").otherwise("product_attribute")
    if meta is None:
        return df.withColumn("predictor_type", rule)
    known = meta.groupBy("predictor").agg(F.min("predictor_type").alias("_known"))
    return df.join(known, "predictor", "left").withColumn("predictor_type", F.coalesce("_known", rule)).drop("_known")


def with_display_names(df: DataFrame, names: DataFrame, locale: str) -> DataFrame:
    """Display name in the locale, else English, else the predictor itself."""
    dim = names.groupBy("predictor").agg(F.min(f"name_{locale}").alias("_local"), F.min("name_en").alias("_en"))
    return df.join(dim, "predictor", "left").withColumn("display_name", F.coalesce("_local", "_en", "predictor")).drop("_local", "_en")
