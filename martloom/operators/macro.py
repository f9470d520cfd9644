"""Monthly, quarterly and yearly trend tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.aggregate import distinct_with_all, presence, side_by_side, sum_with_all

SCOPE = ["platform_id", "product_line_id"]
GRAINS = {"month": "MM", "quarter": "QUARTER", "year": "YEAR"}


def macro_period(sales: DataFrame, grain: str, platforms_together: bool = False) -> DataFrame:
    """Revenue, orders, active and new customers per period; distinct counts start from orders and customers, not from sums."""
    rows = sales.withColumn("platform_id", F.lit("all")) if platforms_together else sales
    platform, line = SCOPE
    scope = [platform, "period"]
    seen = presence(rows.withColumn("period", F.trunc("order_date", GRAINS[grain])), [*scope, line, "order_id", "customer_id"], "lineproduct_price")
    # a customer's first period in each line, and the first of those for all lines
    first = seen.groupBy(platform, line, "customer_id").agg(F.min("period").alias("period"))
    overall = seen.groupBy(platform, "customer_id").agg(F.min("period").alias("period")).withColumn(line, F.lit("all"))
    parts = {
        "revenue": sum_with_all(seen, scope, line, "revenue"),
        "orders": distinct_with_all(seen, scope, line, "order_id", "orders"),
        "active_customers": distinct_with_all(seen, scope, line, "customer_id", "active_customers"),
        "new_customers": first.unionByName(overall).groupBy(*SCOPE, "period").agg(F.count(F.lit(1)).alias("new_customers")),
    }
    return side_by_side(parts, [*SCOPE, "period"], ["orders", "active_customers", "new_customers"])


def macro_monthly(sales: DataFrame) -> DataFrame:
    return macro_period(sales, "month")


def macro_category(sales: DataFrame) -> DataFrame:
    """Monthly measures per line over all platforms, counted again from source rows."""
    return macro_period(sales, "month", platforms_together=True)


def month_spine(monthly: DataFrame) -> DataFrame:
    """Every month between a scope's first and last; at most a few hundred rows per scope."""
    span = monthly.groupBy(*SCOPE).agg(F.min("period").alias("a"), F.max("period").alias("b"))
    return span.select(*SCOPE, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("period"))


def with_growth(monthly: DataFrame, value: str = "revenue") -> DataFrame:
    """Month-over-month and year-over-year change on a dense spine; null on a zero or missing base."""
    dense = month_spine(monthly).join(monthly, [*SCOPE, "period"], "left")
    w = Window.partitionBy(*SCOPE).orderBy("period")
    change = lambda base: F.when(base != 0, (F.col(value) - base) / base)
    return dense.withColumn("mom_growth", change(F.lag(value, 1).over(w))).withColumn("yoy_growth", change(F.lag(value, 12).over(w)))


def flag_partial(monthly: DataFrame, asof: Column) -> DataFrame:
    """The month of the as-of day is partial unless it is that month's last day."""
    return monthly.withColumn("is_partial_month", (F.trunc(asof, "MM") == F.col("period")) & (asof < F.last_day(asof)))
