"""Item positions on review topics, coverage audit and market-entry benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.money import exact_mean
from martloom.operators.lookup import fill_sales
from martloom.operators.poisson import MODEL, compress, fit
from martloom.operators.reshape import ratings_wide
from martloom.ordering import quantiles

KEYS = ["product_line_id", "product_id"]


def position(ratings: DataFrame, topics: list[str], own: DataFrame, competitor: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per (line, item): topic means, sales, brand and ownership."""
    wide = ratings_wide(ratings, KEYS, topics)
    return fill_sales(wide, own, competitor, "product_id").join(profile.select(*KEYS, "brand", "is_own"), KEYS, "left")


def topic_coverage(properties: DataFrame, ratings: DataFrame, scored_types: list[str], display_types: list[str], threshold: float = 0.3) -> DataFrame:
    """Why each (line, topic) is shown or not, with its share of rated items."""
    per_item = ratings.groupBy(*KEYS, "topic").agg(F.count("rating").alias("_n"))
    items = per_item.groupBy("product_line_id").agg(F.count_distinct("product_id").alias("n_items"))
    rated = per_item.groupBy("product_line_id", "topic").agg(F.count_if(F.col("_n") > 0).alias("n_rated"))
    joined = properties.join(items, "product_line_id", "left").join(rated, ["product_line_id", "topic"], "left")
    share = F.coalesce("n_rated", F.lit(0)) / F.col("n_items")
    # Names of the fates
    fate = (
        F.when(~F.col("type").isin(scored_types), "type_not_scored")
        .when(F.coalesce("n_rated", F.lit(0)) == 0, "not_rated")
        .when(share < threshold, "low_coverage")
        .when(~F.col("type").isin(display_types), "not_display_type")
        .otherwise("displayed")
    )
    return joined.select("product_line_id", "topic", "n_items", F.coalesce("n_rated", F.lit(0)).alias("n_rated"), (share * 100).alias("coverage_pct"), fate.alias("fate"))


def benchmark(item_ratings: DataFrame) -> DataFrame:
    """Spread of competitor item means per (line, topic)."""
    keys = ["product_line_id", "topic"]
    rivals = item_ratings.filter("not is_own and rating is not null")
    moments = rivals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), exact_mean("rating").alias("mean"), F.stddev("rating").alias("sd"))
    return moments.join(quantiles(rivals, keys, "rating", {"p25": 0.25, "p50": 0.5, "p75": 0.75}), keys)


def entry_model(long: DataFrame, min_items: int = 8) -> DataFrame:
    """Competitor coefficients with a verdict: withheld when items are few or all alike."""
    fitted = fit(compress(long))
    thin = (F.col("sample_size") < min_items) | F.coalesce(F.col("predictor_range") == 0, F.lit(True))
    verdict = F.when(thin, "withheld").when(F.col("estimation_status") == "estimated", "usable").otherwise("not_estimable")
    return fitted.select(*MODEL, "sample_size", "coefficient", "std_error", "p_value", verdict.alias("verdict"))
