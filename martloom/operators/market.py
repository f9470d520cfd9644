"""Market model: what drives item sales across own and competing products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.negbin import histogram, with_fallback
from martloom.operators.poisson import MODEL, compress, fit
from martloom.operators.window import all_true_per_key
from martloom.session import materialise, sized

NO_MARKET = "__no_market_data__"
OVERDISPERSED = 25.0  # Pearson dispersion beyond which standard errors alone no longer mend a Poisson model


def ownership(items: DataFrame, item: str, flags: DataFrame, own_series: DataFrame) -> DataFrame:
    """Explicit flag, else own if the item has an own sales series, else competitor."""
    f = flags.select(item, F.col("is_own").alias("_flag"))
    o = own_series.select(item).distinct().withColumn("_series", F.lit(True))
    return (
        items.join(f, item, "left").join(o, item, "left").withColumn("is_own", F.coalesce("_flag", "_series", F.lit(False))).drop("_flag", "_series")
    )


def dense_indicators(items: DataFrame, hot: DataFrame, item: str) -> DataFrame:
    """0/1 rows for every (item, level used in its line); the level list is small and keyed by line."""
    keyed = hot.join(items.select(item, "product_line_id"), item)
    levels = sized(keyed.select("product_line_id", "predictor").distinct())
    return (
        items.select(item, "product_line_id")
        .join(levels, "product_line_id")
        .join(hot.select(item, "predictor", "x"), [item, "predictor"], "left")
        .select(item, "product_line_id", "predictor", F.coalesce("x", F.lit(0.0)).alias("x"))
    )


def market_frame(items: DataFrame, item: str, indicators: DataFrame, topics: DataFrame) -> DataFrame:
    """Long model input: (line, predictor, x) with the item's sales, exposure and ownership.

    `items` has one row per item with sales, months_listed and is_own; `indicators` and `topics`
    are long (item, line, predictor, x).
    """
    x = indicators.unionByName(topics.select(*indicators.columns))
    measures = items.select(item, F.col("sales").alias("y"), F.col("months_listed").cast("double").alias("exposure"), "is_own")
    return x.join(measures, item).select(*MODEL, "x", "y", "exposure", "is_own")


def market_model(frame: DataFrame, min_obs: int = 3, overdispersed: float = OVERDISPERSED) -> DataFrame:
    """Quasi-Poisson with exposure offset per (line, attribute); too few items withholds the model.

    Where sales scatter more than `overdispersed` times as widely as counts would, the negative binomial
    takes over.
    """
    frame = materialise(frame, "market-frame")
    counts = frame.filter("x is not null and y is not null").groupBy(*MODEL).agg(
        F.count_if("is_own").alias("n_own"), F.count_if(~F.col("is_own")).alias("n_competitor")
    )
    levels = materialise(compress(frame), "levels")
    fitted = with_fallback(fit(levels, quasi=True, min_rows=min_obs), levels, histogram(frame), overdispersed)
    return (
        fitted.join(counts, MODEL, "left")
        .withColumn("competitor_included", F.coalesce(F.col("n_competitor") > 0, F.lit(False)))
    )


def label_attributes(results: DataFrame, scales: DataFrame) -> DataFrame:
    """Scale and kind of each attribute, and the rate ratio over its whole observed range."""
    known = scales.groupBy(*MODEL).agg(F.min("scale").alias("scale"))
    kind = F.when(F.col("scale") == "2尺度", "mention_proportion").when(F.col("scale").isNotNull(), "rating").otherwise("product_feature")
    return (
        results.join(known, MODEL, "left")
        .withColumn("attr_kind", kind)
        .withColumn("predictor_type", F.when(kind == "mention_proportion", "comment_attribute").otherwise("product_attribute"))
        .withColumn("irr_display", F.exp(F.col("coefficient") * F.col("predictor_range")))
    )


def modelable_topics(ratings: DataFrame, properties: DataFrame, types: tuple[str, ...] = ("attribute",)) -> DataFrame:
    """Topic rows (product_line_id, predictor, ..) whose property is of a modelable type in their line.

    A topic may be listed more than once in a line; one entry of another type rules it out.
    """
    listed = properties.select("product_line_id", F.col("topic").alias("predictor"), F.col("type").isin(*types).alias("modelable"))
    kept = all_true_per_key(listed, ["product_line_id", "predictor"], "modelable").filter("modelable").select("product_line_id", "predictor")
    return ratings.join(kept, ["product_line_id", "predictor"], "left_semi").select(*ratings.columns)


def attribute_coverage(universe: DataFrame, results: DataFrame) -> DataFrame:
    """Fate of every declared attribute (line, predictor, consumed, is_numeric, is_rated)."""
    r = results.select(*MODEL, "estimation_status", "p_value")
    # Names of the fates
    fate = (
        F.when(~F.col("consumed"), "source_table_not_consumed")
        .when(~F.col("is_numeric"), "non_numeric")
        .when(~F.col("is_rated"), "topic_not_rated")
        .when(F.coalesce(F.col("estimation_status"), F.lit("")) != "estimated", "not_estimable")
        .when(F.col("p_value") < 0.05, "significant")
        .otherwise("not_significant")
    )
    return universe.join(r, MODEL, "left").select(*MODEL, fate.alias("fate"))


def significant() -> Column:
    return (F.col("estimation_status") == "estimated") & (F.col("p_value") < 0.05)


def drivers(results: DataFrame) -> DataFrame:
    return results.filter(significant())


def market_reasons(lines: DataFrame, items: DataFrame, attributes: DataFrame) -> DataFrame:
    """(product_line_id, drop_reason) of every line without a market model, by the first thing it lacks.

    `items` has product_line_id, product_id and sales; `attributes` is long with (line, predictor, x).
    """
    profile = items.groupBy("product_line_id").agg(
        F.count("product_id").alias("_items"), F.count_if(F.col("sales").isNotNull() & F.col("product_id").isNotNull()).alias("_sold")
    )
    numeric = attributes.groupBy("product_line_id").agg(F.count("x").alias("_x"))
    # Names of the reasons
    reason = (
        F.when(F.col("_items").isNull(), "no_product_profile")
        .when(F.col("_items") == 0, "profile_no_item_id")
        .when(F.coalesce(F.col("_x"), F.lit(0)) == 0, "no_numeric_attrs")
        .when(F.col("_sold") == 0, "no_sales")
    )
    joined = lines.select("product_line_id").distinct().join(profile, "product_line_id", "left").join(numeric, "product_line_id", "left")
    return joined.select("product_line_id", reason.alias("drop_reason")).filter("drop_reason is not null")


def market_sentinel(lines: DataFrame, results: DataFrame, reason: str = "no_position_rows", reasons: DataFrame | None = None) -> DataFrame:
    """A visible row for each line without any market result, with its own reason where `reasons` has one."""
    absent = lines.select("product_line_id").distinct().join(results, "product_line_id", "left_anti")
    cause = F.lit(reason)
    if reasons is not None:
        absent = absent.join(reasons.select("product_line_id", F.col("drop_reason").alias("_reason")), "product_line_id", "left")
        cause = F.coalesce("_reason", F.lit(reason))
    rows = absent.select(
        "product_line_id",
        F.lit(NO_MARKET).alias("predictor"),
        F.lit("structural").alias("predictor_type"),
        F.lit("not_estimable").alias("estimation_status"),
        cause.alias("drop_reason"),
        F.lit(False).alias("competitor_included"),
    )
    return results.unionByName(rows, allowMissingColumns=True)
