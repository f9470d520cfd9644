"""Grouped measures, distributions, roll-ups and share columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.money import MONEY, exact_mean, exact_sum
from martloom.operators.sets import union_all
from martloom.session import attach_row, materialise, sized


def with_rollup_all(df: DataFrame, dim: str, out: str | None = None, label: str = "all") -> DataFrame:
    """Repeat each row under its own `dim` value and under `label`, ahead of one partial aggregate."""
    out = out or dim
    rolled = df.withColumn("_dim", F.explode(F.array(F.col(dim), F.lit(label))))
    return rolled.drop(dim).withColumnRenamed("_dim", out)


def presence(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """One row per `by` with the exact sum of `value` (decimal), written: every roll-up below starts here, not at source rows."""
    return materialise(df.groupBy(*by).agg(F.sum(F.col(value).cast(MONEY)).alias("_value")), "presence")


def distinct_with_all(rows: DataFrame, scope: list[str], dim: str, who: str, out: str, label: str = "all") -> DataFrame:
    """Distinct `who` per scope and `dim` value, and under `label` for all values together; no row is repeated for it."""
    held = rows.filter(F.col(who).isNotNull())
    each = held.select(*scope, dim, who).distinct().groupBy(*scope, dim).agg(F.count(F.lit(1)).alias(out))
    every = held.select(*scope, who).distinct().groupBy(*scope).agg(F.count(F.lit(1)).alias(out))
    return each.unionByName(every.withColumn(dim, F.lit(label)))


def sum_with_all(rows: DataFrame, scope: list[str], dim: str, out: str) -> DataFrame:
    """Exact sum of a presence table per scope and `dim` value; `all` rows come from these few sums."""
    sums = rows.groupBy(*scope, dim).agg(F.sum("_value").alias("_value"))
    return with_rollup_all(sums, dim).groupBy(*scope, dim).agg(F.sum("_value").cast("double").alias(out))


def side_by_side(parts: dict[str, DataFrame], keys: list[str], counts: list[str]) -> DataFrame:
    """One row per key (nulls are a key) with each part's measure; counts are zero where a part lacks the key."""
    joined = union_all(*parts.values()).groupBy(*keys).agg(*[F.max(c).alias(c) for c in parts])
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def daily_sales(sales: DataFrame, item: str = "product_id") -> DataFrame:
    return sales.groupBy(item, "product_line_id", "order_date").agg(
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("sales"),
        F.coalesce(exact_sum("lineproduct_price"), F.lit(0.0)).alias("sales_platform"),
    )


def review_stats(reviews: DataFrame, key: str, helpful: str) -> DataFrame:
    return reviews.groupBy(key).agg(F.count(F.lit(1)).alias("review_count"), exact_mean(helpful).alias("avg_helpful"))


def item_totals(sales: DataFrame, key: str, value: str = "quantity", out: str = "total_sales") -> DataFrame:
    return sales.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def n_distinct(df: DataFrame, columns: dict[str, str], by: list[str] | None = None, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*(by or [])).agg(*[count(c).alias(out) for out, c in columns.items()])


def profile_counts(df: DataFrame, rules: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """`count(case when …)` for many named rules in one pass."""
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()])


def col_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """min, max and mean per column as long rows, one pass over the table."""
    stats = df.agg(*[agg for c in cols for agg in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"), exact_mean(c).alias(f"{c}__mean"))])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__lo").cast("double").alias("min_value"),
                F.col(f"{c}__hi").cast("double").alias("max_value"),
                F.col(f"{c}__mean").alias("avg_value"),
            )
            for c in cols
        ]
    )
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def freq(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), col)


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    return freq(df, col).limit(k)


def monthly_distribution(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count(F.lit(1)).alias("n_orders"))


def date_context(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count(F.lit(1)).alias("total_rows"))


def dup_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def conflict_groups(df: DataFrame, item: str, line: str) -> DataFrame:
    """Items in several lines with the sorted list; lines are made distinct before they are listed."""
    return (
        df.filter(F.col(line).isNotNull())
        .select(item, line)
        .distinct()
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("n_lines"), F.array_join(F.array_sort(F.collect_list(line)), ", ").alias("line_list"))
        .filter("n_lines > 1")
    )


def with_pct(counts: DataFrame, n: str = "n", by: list[str] | None = None) -> DataFrame:
    """Share of the total; the total is an aggregate joined back, not a window over all rows."""
    if by:
        return counts.join(sized(counts.groupBy(*by).agg(F.sum(n).alias("_total"))), by).withColumn("pct", F.col(n) / F.col("_total") * 100).drop("_total")
    total = counts.agg(F.sum(n).alias("_total"))
    return attach_row(counts, total).withColumn("pct", F.col(n) / F.col("_total") * 100).drop("_total")


def summary_by_hierarchy(coefficients: DataFrame) -> DataFrame:
    return coefficients.groupBy("time_hierarchy").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce("year_label", "month_label", "quarter_label", "week_label", "day_label").isNotNull()).alias("n_labelled"),
        F.avg("incidence_rate_ratio").alias("mean_irr"),
    )


def product_features(sales: DataFrame) -> DataFrame:
    """Per product: counts, quantity and price statistics, observed range and track multiplier."""
    span = F.max("unit_price") - F.min("unit_price")
    return (
        sales.withColumn("unit_price", F.col("gross_price") / F.col("quantity"))
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("n_sales"),
            F.count_distinct("order_date").alias("sales_days"),
            F.sum("quantity").alias("sum_quantity"),
            (F.sum("quantity") / F.count("quantity")).alias("avg_quantity"),
            F.min("quantity").alias("min_quantity"),
            F.max("quantity").alias("max_quantity"),
            exact_mean("unit_price").alias("avg_price"),
            F.min("unit_price").alias("min_price"),
            F.max("unit_price").alias("max_price"),
            span.alias("price_range"),
            F.when(span > 0, 100 / span).otherwise(100.0).alias("track_multiplier"),
        )
    )


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """Share of non-null values among `cols` in each row."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.withColumn("completeness_score", filled / len(cols))
