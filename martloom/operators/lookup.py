"""Joins, lookup cascades, registries and key reconciliation.

No hint forces a broadcast: Spark broadcasts a side whose size, estimated or measured at run
time, is under its threshold and sorts both sides beyond it. Maps are made unique on their key
before a lookup, so a lookup cannot change the row count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.clean import is_blank
from martloom.operators.window import first_n_per_key
from martloom.ordering import ranked
from martloom.session import attach_row


def join_order_details(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Both key parts are needed: order ids repeat across sellers."""
    return orders.join(
        details, (orders.order_id == details.order_id) & (orders.seller_email == details.batch_key)
    ).drop(details.order_id)


def join_diagnostics(build: DataFrame, probe: DataFrame, keys: list[str], warn_below: float = 50.0) -> DataFrame:
    """Duplicate, null and shared keys of a planned join in one row."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    b = build.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b"))
    p = probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("_p"))
    joined = b.join(p, keys, "full")
    covered = F.sum(F.when(F.col("_b").isNotNull() & F.col("_p").isNotNull(), F.col("_p")).otherwise(0))
    return joined.agg(
        F.count_if(F.col("_b") > 1).alias("duplicate_build_keys"),
        F.coalesce(F.sum(F.when(null_key, F.coalesce("_b", F.lit(0)) + F.coalesce("_p", F.lit(0)))), F.lit(0)).alias("null_key_rows"),
        F.count_if(F.col("_b").isNotNull() & F.col("_p").isNotNull()).alias("shared_keys"),
        (covered * 100 / F.sum("_p")).alias("coverage_pct"),
    ).withColumn("status", F.when(F.col("coverage_pct") < warn_below, "WARN").otherwise("PASS"))


def unique_map(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: smallest non-blank value, trimmed."""
    return mapping.filter(~is_blank(key) & ~is_blank(value)).groupBy(F.trim(key).alias("_key")).agg(F.min(F.trim(value)).alias("_value"))


def fill_from_maps(df: DataFrame, maps: list[tuple[str, DataFrame, str, str]], target: str = "product_line_id") -> DataFrame:
    """Fill `target` where blank from (name, map, row key, map key) in order; `filled_by` names the map used."""
    out = df.withColumn("_cur", F.when(~is_blank(target), F.trim(target))).withColumn(
        "filled_by", F.when(F.col("_cur").isNotNull(), "present")
    )
    # rows without a key must not meet in one task of a shuffled join
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("string")
    for name, mapping, row_key, map_key in maps:
        known = unique_map(mapping, map_key, target)
        out = (
            out.withColumn("_rk", F.coalesce(F.trim(F.col(row_key).cast("string")), F.concat(F.lit("\u0000"), spread)))
            .join(known, F.col("_rk") == F.col("_key"), "left")
            .withColumn("filled_by", F.coalesce("filled_by", F.when(F.col("_value").isNotNull(), F.lit(name))))
            .withColumn("_cur", F.coalesce("_cur", "_value"))
            .drop("_rk", "_key", "_value")
        )
    return out.withColumn(target, F.col("_cur")).drop("_cur")


def fill_from_mapping(df: DataFrame, mapping: DataFrame, target: str = "product_line_id") -> DataFrame:
    """Cascade over the two keys of one mapping table: sku, then item id."""
    return fill_from_maps(df, [("sku", mapping, "sku", "sku"), ("item", mapping, "item_id", "item_id")], target)


def fanout_map(sales: DataFrame, mapping: DataFrame, item: str, line: str = "product_line_id") -> DataFrame:
    """One row per (sale, line the item belongs to)."""
    return sales.drop(line).join(mapping.select(item, line).distinct(), item, "left")


def left_join_strict(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join that must keep the row count: a repeated right-side key is an error."""
    repeated = right.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"right side repeats key {repeated[0].asDict()} on {on}")
    return left.join(right, on, "left")


def enrich_profile(series: DataFrame, profiles: DataFrame, item: str) -> DataFrame:
    """Profile attributes of the same item *in the same line*."""
    keys = [item, "product_line_id"]
    return left_join_strict(series, first_n_per_key(profiles, keys, [c for c in profiles.columns if c not in keys], 1), keys)


def enrich_reviews(series: DataFrame, stats: DataFrame, item: str) -> DataFrame:
    return series.join(stats, item, "left").withColumn("review_count", F.coalesce("review_count", F.lit(0)))


def join_ratings(series: DataFrame, ratings: DataFrame, item: str) -> DataFrame:
    """Item ratings as `{topic}_rating` columns; items without ratings keep nulls."""
    topics = [c for c in ratings.columns if c != item]
    return series.join(ratings.select(item, *[F.col(t).alias(f"{t}_rating") for t in topics]), item, "left")


def antijoin_backfill(profiles: DataFrame, known: DataFrame, on: list[str], brand: str = "UNKNOWN", header: str = "profile_backfill") -> DataFrame:
    """Known rows plus profile items they lack, tagged with a default brand and header."""
    missing = profiles.select(*on).distinct().join(known, on, "left_anti")
    added = missing.withColumn("brand", F.lit(brand)).withColumn("source_header", F.lit(header))
    return known.unionByName(added, allowMissingColumns=True).distinct()


def reconcile_keys(source: DataFrame, local: DataFrame, on: list[str]) -> DataFrame:
    """Keys on one side only."""
    s, l = source.select(*on).distinct(), local.select(*on).distinct()
    return s.join(l, on, "left_anti").withColumn("side", F.lit("missing_locally")).unionByName(
        l.join(s, on, "left_anti").withColumn("side", F.lit("extra_locally"))
    )


def flag_membership(df: DataFrame, keys: DataFrame, on: list[str], out: str) -> DataFrame:
    marked = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    return df.join(marked, on, "left").withColumn(out, F.col("_hit").isNotNull()).drop("_hit")


def join_reviews_items(reviews: DataFrame, items: DataFrame, pattern: str, item: str, url: str = "url") -> DataFrame:
    """Inner join on the item id found in the review's URL."""
    found = reviews.withColumn("_id", F.nullif(F.regexp_extract(url, pattern, 1), F.lit("")))
    return found.join(items, F.col("_id") == F.col(item).cast("string")).drop("_id")


def with_line_name(df: DataFrame, dim: DataFrame, on: str = "product_line_id") -> DataFrame:
    """Line name in the local language, else English."""
    names = dim.select(on, F.coalesce(F.when(~is_blank("name_local"), F.col("name_local")), F.col("name_en")).alias("product_line_name"))
    return df.join(names, on, "left")


def join_suffix(left: DataFrame, right: DataFrame, on: list[str], suffix: str = "_profile") -> DataFrame:
    """Left join where a name on both sides is suffixed on the left; leftovers of older merges are an error."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    out = left.withColumnsRenamed({c: f"{c}{suffix}" for c in shared}).join(right, on, "left")
    residue = [c for c in out.columns if c.endswith((".x", ".y"))]
    if residue or len(set(out.columns)) != len(out.columns):
        raise ValueError(f"join leaves ambiguous columns {residue or out.columns}")
    return out


def fill_sales(df: DataFrame, own: DataFrame, competitor: DataFrame, item: str) -> DataFrame:
    """Own position sales, else the competitor total, else zero, with the source named."""
    o, c = own.select(item, F.col("sales").alias("_own")), competitor.select(item, F.col("sales").alias("_comp"))
    return (
        df.join(o, item, "left")
        .join(c, item, "left")
        .withColumn("sales", F.coalesce("_own", "_comp", F.lit(0.0)))
        .withColumn("sales_source", F.when(F.col("_own").isNotNull(), "own").when(F.col("_comp").isNotNull(), "competitor").otherwise("none"))
        .drop("_own", "_comp")
    )


def assign_ids(df: DataFrame, key: list[str], registry: DataFrame, out: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """(rows with ids, extended registry). Known keys keep their id; new keys follow the largest one in key order."""
    fresh = df.dropna(subset=key).select(*key).distinct().join(registry, key, "left_anti")
    top = registry.agg(F.coalesce(F.max(out), F.lit(0)).alias("_top"))
    numbered = attach_row(ranked(fresh, [], key, "_n"), top).select(*key, (F.col("_top") + F.col("_n")).cast("long").alias(out))
    grown = registry.select(*key, F.col(out).cast("long").alias(out)).unionByName(numbered)
    return df.join(grown, key, "left"), grown


def resolve_line(df: DataFrame, dim: DataFrame, name: str, out: str = "product_line_id") -> tuple[DataFrame, DataFrame]:
    """Resolve an id, English or local name to the line id; second frame holds unresolved non-blank values."""
    keys = F.array(F.col("product_line_id"), F.col("name_en"), F.col("name_local"))
    names = (
        dim.select(F.col("product_line_id").alias("_line"), F.posexplode(keys).alias("_rank", "_name"))
        .filter(~is_blank("_name"))
        .select(F.lower(F.trim("_name")).alias("_name"), F.struct("_rank", "_line").alias("_pick"))
        .groupBy("_name")
        .agg(F.min("_pick")["_line"].alias(out))
    )
    probe = F.lower(F.trim(F.col(name)))
    resolved = df.drop(out).join(names, probe == F.col("_name"), "left").drop("_name")
    failed = resolved.filter(F.col(out).isNull() & ~is_blank(name)).select(name).distinct()
    return resolved, failed


def with_definitions(long: DataFrame, definitions: DataFrame) -> DataFrame:
    return long.join(definitions, ["product_line_id", "topic"], "left")


def fk_violations(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    return child.select(*on).distinct().join(parent, on, "left_anti")
