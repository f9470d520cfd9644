"""Per-key selection, sequence numbers, de-duplication and sorted output.

`row_number() <= k` is kept where k is small: Spark then limits every map task to k rows per
key before the shuffle, so a hot key cannot flood one task. Numbers for *all* rows of a key use
the range-partitioned helpers instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.ordering import ranked


def first_n_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def latest_per_key(df: DataFrame, keys: list[str], date: str, tie: list) -> DataFrame:
    """Newest row per key. Rows with a null key part are rejected, not merged into one."""
    whole = df.dropna(subset=keys)
    return first_n_per_key(whole, keys, [F.col(date).desc_nulls_last(), *tie], 1)


def dedup_by_priority(df: DataFrame, keys: list[str], rank: str, tie: list) -> DataFrame:
    return first_n_per_key(df, keys, [F.col(rank), *tie], 1)


def dedup(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return first_n_per_key(df, keys, order, 1)


def dedup_fanout(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per (item, marketplace, line): an item may stay in several lines."""
    return first_n_per_key(df, keys, order, 1)


def tail_per_group(df: DataFrame, keys: list[str], date: str, tie: list, n: int = 30, where: Column | None = None) -> DataFrame:
    """Newest n rows per group among the rows that satisfy `where`; other rows pass untouched."""
    if where is None:
        return first_n_per_key(df, keys, [F.col(date).desc_nulls_last(), *tie], n)
    hit = F.coalesce(where, F.lit(False))
    return first_n_per_key(df.filter(hit), keys, [F.col(date).desc_nulls_last(), *tie], n).unionByName(df.filter(~hit))


def head_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return first_n_per_key(df, keys, order, n)


def make_txn_id(df: DataFrame, order_id: str, order: list) -> DataFrame:
    """`{order}_{001}` by position in the order; exact even when one order id holds most rows."""
    return (
        ranked(df, [order_id], order, "_seq")
        .withColumn("transaction_id", F.format_string("%s_%03d", F.col(order_id).cast("string"), F.col("_seq")))
        .drop("_seq")
    )


def suffix_duplicates(df: DataFrame, key: str, order: list, out: str) -> DataFrame:
    """Append `_n` to every repeat of a key that is not unique; unique keys stay as they are."""
    return (
        ranked(df, [key], order, "_seq", "_size")
        .withColumn(out, F.when(F.col("_size") > 1, F.concat_ws("_", F.col(key).cast("string"), F.col("_seq").cast("string"))).otherwise(F.col(key).cast("string")))
        .drop("_seq", "_size")
    )


def surrogate(df: DataFrame, order: list, out: str = "mapping_id") -> DataFrame:
    """Dense 1..n id in a total order, without a single-task window."""
    return ranked(df, [], order, out)


def winner_flag(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Flag the first row of each key. The minimum is a partial aggregate, so hot keys stay cheap."""
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_win"))
    return df.join(first, key).withColumn("is_winner", F.struct(*order) == F.col("_win")).drop("_win")


def drop_exact_dups(df: DataFrame) -> DataFrame:
    """Only rows equal in every column are duplicates."""
    return df.distinct()


def all_true_per_key(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """A key keeps the flag only if every one of its rows has it."""
    return df.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col(flag), F.lit(False))).alias(flag))


def sort(df: DataFrame, keys: list) -> DataFrame:
    return df.orderBy(*keys)


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows in order; Spark keeps n rows per task before the merge."""
    return df.orderBy(*order).limit(n)


# Display ranks of the time hierarchies. Fixed values.
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def with_display_order(df: DataFrame) -> DataFrame:
    level = F.col("time_hierarchy")
    day = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("predictor")), F.lit(0).cast("long")), F.lit(8))
    order = (
        F.when(level == "year", 1000)
        .when(level == "quarter", 2000 + F.coalesce("analysis_quarter", F.lit(0)))
        .when(level == "month", 3000 + F.coalesce("analysis_month", F.lit(0)))
        .when(level == "weekday", 4000 + day)
        .when(level == "day", 5000)
        .otherwise(9999)
    )
    return df.withColumn("display_order", order.cast("int"))


def top_drift(before: DataFrame, after: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The k keys whose value moved most between two snapshots."""
    b = before.select(*keys, F.col(value).alias("value_before"))
    a = after.select(*keys, F.col(value).alias("value_after"))
    moved = b.join(a, keys).withColumn("delta", F.col("value_after") - F.col("value_before"))
    return moved.orderBy(F.abs("delta").desc(), *keys).limit(k)


def top_significant(coefficients: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Significant rows first, then by p value."""
    return coefficients.orderBy((F.col("p_value") < 0.05).desc(), F.col("p_value").asc_nulls_last(), *keys).limit(k)
