"""Unions, key-set algebra and snapshot differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; a column absent from one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def union_tagged(parts: dict[str, DataFrame], tag: str = "product_line_id") -> DataFrame:
    """Per-group tables, tagged with their group."""
    return union_all(*[df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def intersect_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def product_master(lines: dict[str, DataFrame]) -> DataFrame:
    """All lines' attribute tables in one; attributes a line lacks are null."""
    return union_tagged(lines)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], value: str, significant: str, tolerance: float = 1e-6) -> DataFrame:
    """Classify every key of two snapshots: new, dropped, drifted or unchanged; flag significance flips."""
    b = before.select(*keys, F.col(value).alias("value_before"), F.col(significant).alias("sig_before"), F.lit(True).alias("_b"))
    a = after.select(*keys, F.col(value).alias("value_after"), F.col(significant).alias("sig_after"), F.lit(True).alias("_a"))
    both = F.col("_b") & F.col("_a")
    moved: Column = F.abs(F.col("value_after") - F.col("value_before")) > tolerance
    return (
        b.join(a, keys, "full")
        .withColumn(
            "change",
            F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "dropped").when(F.coalesce(moved, F.lit(False)), "drifted").otherwise("unchanged"),
        )
        .withColumn("significance_flip", F.coalesce(both & (F.col("sig_before") != F.col("sig_after")), F.lit(False)))
        .drop("_a", "_b")
    )


def category_balance(before: DataFrame, after: DataFrame, category: str) -> DataFrame:
    """Row counts per category in two snapshots."""
    b = before.groupBy(category).agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy(category).agg(F.count(F.lit(1)).alias("n_after"))
    return b.join(a, category, "full").select(
        category, F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after")
    )
