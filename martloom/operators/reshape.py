"""Nested-to-flat, wide/long, dense series and exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import month_index, months_span
from martloom.operators.clean import blank_to_null
from martloom.session import attach_row, materialise, sized


def explode_items(orders: DataFrame, items: str = "line_items") -> DataFrame:
    """One row per order item with its position; orders without items have no rows."""
    head = [c for c in orders.columns if c != items]
    flat = orders.select(*head, F.posexplode(items).alias("_pos", "_item"))
    return flat.select(*head, (F.col("_pos") + 1).alias("item_seq"), "_item.*").withColumn(
        "item_id", F.concat_ws("_", F.col("order_id").cast("string"), F.lpad(F.col("item_seq").cast("string"), 3, "0"))
    )


def wide_to_long(df: DataFrame, ids: list[str], cols: list[str], name: str = "topic", value: str = "rating") -> DataFrame:
    return df.unpivot(ids, cols, name, value)


def reviews_to_long(reviews: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per (review, topic of its line), the topics being a table keyed by line."""
    return reviews.join(topics, "product_line_id")


def ratings_wide(ratings: DataFrame, ids: list[str], topics: list[str]) -> DataFrame:
    """Mean rating per topic as one column each; the explicit topic list keeps it one job."""
    return ratings.groupBy(*ids).pivot("topic", sorted(topics)).agg(F.avg("rating"))


def binarise(ratings: DataFrame, topics: list[str]) -> DataFrame:
    """Two-level topics become 1.0 when mentioned, else 0.0; null stays null."""
    flag = F.when(F.col("rating").isNotNull(), (F.col("rating") > 0).cast("double"))
    return ratings.withColumn("rating", F.when(F.col("topic").isin(topics), flag).otherwise(F.col("rating")))


def one_hot(df: DataFrame, ids: list[str], cols: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """Long indicator rows `(ids, parent::level, 1.0)` for all columns with more than one value.

    Constant and blank columns say nothing and are left out; `skipped_parents` lists them.
    """
    long = _levels_long(df, ids, [c for c in cols if c not in exclude])
    sizes = _level_counts(long).filter(F.col("k") >= 2)
    return long.join(sized(sizes.select("parent")), "parent").select(*ids, F.concat_ws("::", "parent", "level").alias("predictor"), F.lit(1.0).alias("x"))


def skipped_parents(df: DataFrame, ids: list[str], cols: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """(parent, reason) of the columns that `one_hot` leaves out."""
    named = df.sparkSession.createDataFrame([(c, c in exclude) for c in cols], "parent string, excluded boolean")
    counts = _level_counts(_levels_long(df, ids, cols))
    reason = F.when(F.col("excluded"), "excluded").when(F.col("k").isNull(), "all_blank").when(F.col("k") == 1, "constant")
    return named.join(counts, "parent", "left").withColumn("reason", reason).filter("reason is not null").select("parent", "reason")


def _level_counts(long: DataFrame) -> DataFrame:
    return long.groupBy("parent").agg(F.count_distinct("level").alias("k"))


def _levels_long(df: DataFrame, ids: list[str], used: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("parent"), F.col(c).cast("string").alias("level")) for c in used])
    return (
        blank_to_null(df.select(*ids, *used), [c for c, t in df.dtypes if c in used and t == "string"])
        .select(*ids, F.explode(pairs).alias("p"))
        .select(*ids, "p.parent", "p.level")
        .filter(F.col("level").isNotNull())
    )


def complete_series(df: DataFrame, date: str, group: list[str], values: list[str]) -> DataFrame:
    """Dense daily grid per group over the global first..last day; gaps are 0 and marked FILLED.

    Each real day generates itself and the empty days up to the next one (the first also those
    before it), so only real rows are shuffled and the grid is produced in place. After the daily
    sum a group has one row per calendar day at most, which bounds the window.
    """
    sums = [F.coalesce(F.sum(v).cast("double"), F.lit(0.0)).alias(v) for v in values]
    daily = materialise(df.filter(F.col(date).isNotNull()).groupBy(*group, F.to_date(date).alias(date)).agg(*sums), "daily")
    first, last = daily.agg(F.min(date), F.max(date)).first()
    w = Window.partitionBy(*group).orderBy(date)
    begin = F.when(F.lag(date).over(w).isNull(), F.lit(first)).otherwise(F.col(date))
    end = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.lit(last))
    spans = daily.withColumn("_days", F.sequence(begin, end, F.expr("interval 1 day")))
    grid = spans.withColumn("_day", F.explode("_days"))
    real = F.col("_day") == F.col(date)
    return grid.select(
        *group,
        F.col("_day").alias(date),
        *[F.when(real, F.col(v)).otherwise(0.0).alias(v) for v in values],
        F.when(real, "REAL").otherwise("FILLED").alias("data_source"),
    )


def months_listed(df: DataFrame, item: str, date: str, how: str, sales: str = "sales") -> DataFrame:
    """Exposure in months: `first_to_end` (first selling month to the last month) or `distinct_months`."""
    month = month_index(F.col(date))
    dated = df.filter(F.col(date).isNotNull())
    if how == "distinct_months":
        return dated.groupBy(item).agg(F.count_distinct(month).alias("months_listed"))
    if how != "first_to_end":
        raise ValueError(how)
    per_item = materialise(dated.groupBy(item).agg(F.min(F.when(F.col(sales) > 0, month)).alias("_first"), F.max(month).alias("_last")), "months")
    end = per_item.agg(F.max("_last").alias("_end"))
    return attach_row(per_item, end).select(item, (F.col("_end") - F.col("_first") + 1).alias("months_listed"))


def full_period(dates: DataFrame, date: str) -> DataFrame:
    """One row: months from the first to the last date of own and competitor sales."""
    return dates.agg(months_span(F.min(date), F.max(date)).alias("_full"))


def resolve_exposure(items: DataFrame, item: str, own: DataFrame, competitor: DataFrame, period: DataFrame) -> DataFrame:
    """Own exposure, else competitor exposure, else the whole period (`full_period`); the source is kept."""
    o, c = own.select(item, F.col("months_listed").alias("_o")), competitor.select(item, F.col("months_listed").alias("_c"))
    return (
        attach_row(items.join(o, item, "left").join(c, item, "left"), period)
        .withColumn("months_listed", F.coalesce("_o", "_c", "_full"))
        .withColumn("exposure_source", F.when(F.col("_o").isNotNull(), "own").when(F.col("_c").isNotNull(), "competitor").otherwise("full_period"))
        .drop("_o", "_c", "_full")
    )


def coalesce_suffix(df: DataFrame) -> DataFrame:
    """Fold `c`, `c.x`, `c.y` into `c`."""
    bases = [c for c in df.columns if not c.endswith((".x", ".y"))]
    stems = list(dict.fromkeys([*bases, *[c[:-2] for c in df.columns if c.endswith((".x", ".y"))]]))
    pick = lambda stem: [c for c in (stem, f"{stem}.x", f"{stem}.y") if c in df.columns]
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in pick(stem)]).alias(stem) for stem in stems])
