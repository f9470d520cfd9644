"""Review staging, rating work sets, rating means and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import dates
from martloom.functions.text import quality_tier
from martloom.operators.aggregate import completeness
from martloom.operators.clean import ASIN, error_rows, is_blank, keep_matching
from martloom.operators.lookup import flag_membership, with_definitions
from martloom.operators.reshape import reviews_to_long
from martloom.operators.window import tail_per_group
from martloom.ordering import with_next
from martloom.session import attach_row, materialise, sized

RESULT_KEY = ["review_id", "topic", "model"]
FIELDS = ["platform_id", "product_line_id", "product_id", "review_date", "rating", "review_text"]


def stage_reviews(raw: DataFrame) -> DataFrame:
    """Typed, valid and distinct reviews with date parts, text length and overall fill rate.

    The fill rate is one aggregate row.
    """
    typed = raw.withColumn("review_date", dates.review_date(F.col("date"))).withColumn("rating", F.col("rating").try_cast("int"))
    valid = keep_matching(typed.withColumn("variation", F.trim("variation")), "variation", ASIN).distinct()
    parts = valid.withColumns(
        {"review_year": F.year("review_date"), "review_month": F.month("review_date"), "body_length": F.length("body")}
    )
    filled = (~is_blank("body") & F.col("rating").isNotNull() & F.col("review_date").isNotNull()).cast("int")
    rate = parts.agg((F.sum(filled) * 100 / F.count(F.lit(1))).alias("quality_pct"))
    return attach_row(parts, rate)


def transform_reviews(staged: DataFrame, lines: list[str], competitors: DataFrame) -> DataFrame:
    """Canonical names, line from the drop-folder number, competitor flag, tiers and completeness."""
    number = F.nullif(F.regexp_extract("path", r"reviews/0*(\d+)", 1), F.lit("")).cast("int")
    renamed = staged.withColumnsRenamed({"variation": "product_id", "body": "review_text"}).withColumn(
        "product_line_id", F.try_element_at(F.array(*[F.lit(x) for x in lines]), number)
    )
    flagged = flag_membership(renamed, competitors, ["product_id"], "included_competitor")
    return completeness(quality_tier(flagged), FIELDS)


def rating_frame(reviews: DataFrame, topics: DataFrame, definitions: DataFrame, n: int = 30) -> DataFrame:
    """Newest n reviews of each competing product x topics of their line; own products are not rated."""
    chosen = tail_per_group(reviews.filter(F.col("included_competitor")), ["product_id"], "review_date", ["review_id"], n)
    return with_definitions(reviews_to_long(chosen, topics), definitions)


def result_history(results: DataFrame) -> DataFrame:
    """Append-only results with validity: each row is valid until the key's next result."""
    later = with_next(results, RESULT_KEY, ["rated_at", "result"], ["rated_at"])
    return (
        later.withColumnsRenamed({"rated_at": "valid_from", "next_rated_at": "valid_to"})
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def retry_set(results: DataFrame) -> DataFrame:
    """Failed results that need another attempt."""
    return error_rows(results, "result")


def pending(frame: DataFrame, results: DataFrame) -> DataFrame:
    """Work still to do: frame rows whose newest result is missing or failed."""
    newest = results.groupBy(*RESULT_KEY).agg(F.max(F.struct("rated_at", "result"))["result"].alias("result"))
    failed = error_rows(newest, "result").select(*RESULT_KEY)
    done = newest.join(failed, RESULT_KEY, "left_anti")
    return frame.join(done, RESULT_KEY, "left_anti")


def ratings_by_item(ratings: DataFrame) -> DataFrame:
    """Mean rating per item and topic; null when nobody rated it."""
    return ratings.groupBy("product_line_id", "product_id", "topic").agg(F.avg("rating").alias("rating"))


def impute(items: DataFrame) -> DataFrame:
    """Fill missing item ratings with the line's topic mean, then the topic mean; the flag stays."""
    items = materialise(items, "items")
    by_line = items.groupBy("product_line_id", "topic").agg(F.avg("rating").alias("_line"))
    overall = items.groupBy("topic").agg(F.avg("rating").alias("_topic"))
    return (
        items.join(sized(by_line), ["product_line_id", "topic"])
        .join(sized(overall), "topic")
        .withColumn("imputed", F.col("rating").isNull())
        .withColumn("rating", F.coalesce("rating", "_line", "_topic"))
        .drop("_line", "_topic")
    )
