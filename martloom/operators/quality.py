"""Spec-driven data-quality checks: one aggregate pass per table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom.money import exact_sum
from martloom.operators.clean import is_blank
from martloom.operators.sets import union_all

RESULT_COLUMNS = ["platform_id", "table_name", "check_name", "status", "expected", "actual"]


@dataclass(frozen=True)
class Check:
    """A named measure of a table and the rule that judges it."""

    name: str
    measure: Column
    judge: Callable[[Column], Column]  # measure -> PASS / WARN / FAIL
    expected: str


def _pass_if(rule: Callable[[Column], Column], otherwise: str = "FAIL") -> Callable[[Column], Column]:
    return lambda m: F.when(rule(m), "PASS").otherwise(otherwise)


def chk_rows(minimum: int = 1, where: Column | None = None) -> Check:
    n = F.count(F.lit(1)) if where is None else F.count_if(where)
    return Check("row_count", n, _pass_if(lambda m: m >= minimum), f">= {minimum}")


def chk_nulls(col: str) -> Check:
    return Check(f"null_{col}", F.count_if(is_blank(col)), _pass_if(lambda m: m == 0), "0")


def chk_platform(platforms: list[str]) -> list[Check]:
    p = F.col("platform_id")
    zero = _pass_if(lambda m: m == 0)
    return [
        Check("null_platform", F.count_if(p.isNull()), zero, "0"),
        Check("empty_platform", F.count_if(F.length(F.trim(p)) == 0), zero, "0"),
        Check("foreign_platform", F.count_if(~p.isin(platforms)), zero, "0"),
    ]


def chk_dups(keys: list[str]) -> Check:
    whole = F.struct(*keys)
    return Check(f"duplicate_{'_'.join(keys)}", F.count(whole) - F.count_distinct(whole), _pass_if(lambda m: m == 0), "0")


def chk_tolerance(name: str, difference: Column, tolerance: float = 0.02) -> Check:
    return Check(name, F.count_if(F.abs(difference) > tolerance), _pass_if(lambda m: m == 0, "WARN"), f"|difference| <= {tolerance}")


def chk_domain(col: str, allowed: list[str]) -> Check:
    return Check(f"domain_{col}", F.count_if(~F.col(col).isin(allowed)), _pass_if(lambda m: m == 0, "WARN"), "in " + ",".join(allowed))


def chk_pattern(col: str, pattern: str) -> Check:
    return Check(f"format_{col}", F.count_if(~F.col(col).rlike(pattern)), _pass_if(lambda m: m == 0, "WARN"), pattern)


def run_checks(df: DataFrame, table_name: str, checks: list[Check], by: str | None = None) -> DataFrame:
    """All checks of a table in one pass, optionally per platform."""
    measures = df.groupBy(*([by] if by else [])).agg(*[c.measure.cast("double").alias(f"m{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(c.name).alias("check_name"), c.judge(F.col(f"m{i}")).alias("status"), F.lit(c.expected).alias("expected"), F.col(f"m{i}").alias("actual"))
            for i, c in enumerate(checks)
        ]
    )
    platform = F.col(by) if by else F.lit("all")
    return measures.select(platform.alias("platform_id"), F.lit(table_name).alias("table_name"), F.explode(rows).alias("r")).select(
        "platform_id", "table_name", "r.*"
    )


def chk_columns(df: DataFrame, table_name: str, required: list[str]) -> DataFrame:
    """Required columns, judged from the schema without reading data."""
    missing = [c for c in required if c not in df.columns]
    row = ("all", table_name, "required_columns", "FAIL" if missing else "PASS", ",".join(required), float(len(missing)))
    return df.sparkSession.createDataFrame([row], "platform_id string, table_name string, check_name string, status string, expected string, actual double")


def chk_relation(left: tuple[str, DataFrame], right: tuple[str, DataFrame], relation: str) -> DataFrame:
    """Row counts of two tables compared with `=` or `>=`."""
    (ln, l), (rn, r) = left, right
    counts = l.agg(F.count(F.lit(1)).alias("l"), F.lit(1).alias("_k")).join(r.agg(F.count(F.lit(1)).alias("r"), F.lit(1).alias("_k")), "_k")
    holds = F.col("l") == F.col("r") if relation == "=" else F.col("l") >= F.col("r")
    return counts.select(
        F.lit("all").alias("platform_id"),
        F.lit(ln).alias("table_name"),
        F.lit(f"rows {relation} {rn}").alias("check_name"),
        F.when(holds, "PASS").otherwise("FAIL").alias("status"),
        F.concat(F.lit(f"{relation} "), F.col("r").cast("string")).alias("expected"),
        F.col("l").cast("double").alias("actual"),
    )


def domain_outsiders(df: DataFrame, col: str, domain: DataFrame) -> DataFrame:
    return df.select(col).distinct().join(domain, col, "left_anti")


def assert_pk(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail if a key repeats."""
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if bad:
        raise ValueError(f"primary key {keys} repeats: {bad[0].asDict()}")
    return df


def line_coverage(lines: DataFrame, profiles: DataFrame, competitors: DataFrame, sales: DataFrame, dna: DataFrame) -> DataFrame:
    """Per product line: ids and rows at each stage and the kind of gap."""
    key = "product_line_id"
    count = lambda df, out: df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    distinct = lambda df, out: df.groupBy(key).agg(F.count_distinct("item_id").alias(out))
    parts = {
        "profile_items": distinct(profiles, "profile_items"),
        "competitor_items": distinct(competitors, "competitor_items"),
        "sales_rows": count(sales, "sales_rows"),
        "dna_rows": count(dna, "dna_rows"),
    }
    out = lines.select(key).distinct()
    for part in parts.values():
        out = out.join(part, key, "left")
    out = out.fillna(0, list(parts))
    # Names of the gaps
    gap = (
        F.when(F.col("profile_items") <= 0, "A_missing_profile_source")
        .when((F.col("sales_rows") <= 0) | (F.col("dna_rows") <= 0), "B_profile_present_but_no_sales_coverage")
        .otherwise("OK")
    )
    return out.withColumn("gap_type", gap)


def conservation(before: DataFrame, after: DataFrame, amount: str, line: str = "product_line_id", sentinels: tuple[str, ...] = ("unclassified", "UNKNOWN")) -> DataFrame:
    """Revenue kept between layers and the share without a real line."""
    unclassified = is_blank(line) | F.trim(line).isin(*sentinels)
    b = before.agg(exact_sum(amount).alias("total_before"), F.lit(1).alias("_k"))
    a = after.agg(
        exact_sum(amount).alias("total_after"), exact_sum(F.when(unclassified, F.col(amount)).otherwise(0)).alias("_open"), F.lit(1).alias("_k")
    )
    drift = F.abs(F.col("total_after") - F.col("total_before")) / F.col("total_before")
    return (
        b.join(a, "_k")
        .withColumn("drift", drift)
        .withColumn("unclassified_ratio", F.col("_open") / F.col("total_after"))
        .withColumn("status", F.when(F.col("drift") <= 0.005, "PASS").when(F.col("drift") <= 0.05, "WARN").otherwise("FAIL"))
        .drop("_k", "_open")
    )


def with_drop_counts(df: DataFrame, filters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Apply named filters in turn; the observation tells how many rows each saw, without another pass."""
    seen = Observation("drops")
    kept = F.lit(True)
    measures = [F.count(F.lit(1)).alias("rows_in")]
    for name, rule in filters.items():
        kept = kept & F.coalesce(rule, F.lit(False))
        measures.append(F.count_if(kept).alias(f"after_{name}"))
    return df.observe(seen, *measures).filter(kept), seen


def gate(results: DataFrame, mode: str = "warn") -> DataFrame:
    """Warn mode reports; strict mode raises if any check failed."""
    if mode == "strict":
        failed = results.filter("status = 'FAIL'").select("table_name", "check_name").collect()  # one row for each check of the specification
        if failed:
            raise ValueError("failed checks: " + ", ".join(f"{r[0]}.{r[1]}" for r in failed))
    return results


def all_checks(*results: DataFrame) -> DataFrame:
    return union_all(*results).withColumn("checked_at", F.current_timestamp())


def reconcile_files(imported: DataFrame, manifest: DataFrame, key: str, file: str = "path") -> DataFrame:
    """Rows and distinct keys per file against the manifest (path, rows, keys)."""
    got = imported.groupBy(file).agg(F.count(F.lit(1)).alias("rows_in"), F.count_distinct(key).alias("keys_in"))
    ok = F.coalesce((F.col("rows_in") == F.col("rows")) & (F.col("keys_in") == F.col("keys")), F.lit(False))
    return manifest.join(got, file, "full").withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))
