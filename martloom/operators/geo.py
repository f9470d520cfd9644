"""Sales by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.aggregate import distinct_with_all, presence, side_by_side, sum_with_all
from martloom.operators.clean import shipped


def geo_sales(sales: DataFrame, place: str, all_platforms: bool = False) -> DataFrame:
    """Orders, customers and revenue per platform, place and line; `all` counts each order and customer once."""
    rows = shipped(sales)
    if all_platforms:
        rows = rows.withColumn("platform_id", F.lit("all"))
    scope, line = ["platform_id", place], "product_line_id"
    seen = presence(rows, [*scope, line, "order_id", "customer_id"], "lineproduct_price")
    parts = {
        "orders": distinct_with_all(seen, scope, line, "order_id", "orders"),
        "customers": distinct_with_all(seen, scope, line, "customer_id", "customers"),
        "revenue": sum_with_all(seen, scope, line, "revenue"),
    }
    return side_by_side(parts, [*scope, line], ["orders", "customers"])


def geo_country(sales: DataFrame) -> DataFrame:
    return geo_sales(sales, "country")


def geo_state(sales: DataFrame) -> DataFrame:
    return geo_sales(sales, "state")


def geo_all(sales: DataFrame, place: str) -> DataFrame:
    return geo_sales(sales, place, all_platforms=True)


def customer_country(sales: DataFrame) -> DataFrame:
    """Country of most orders per customer; ties go to the latest order, then the name."""
    counted = sales.groupBy("customer_id", "country").agg(F.count_distinct("order_id").alias("orders"), F.max("order_date").alias("last_order"))
    w = Window.partitionBy("customer_id").orderBy(F.col("orders").desc(), F.col("last_order").desc(), "country")
    return counted.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "last_order")
