"""Customer tables: purchase history, recency/frequency/value, activity, segments, snapshots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.money import MONEY, exact_mean, exact_sum
from martloom.operators.aggregate import with_rollup_all
from martloom.operators.lifetime import PARAMETERS, fit_lifetime
from martloom.ordering import quantiles, running_total, with_tiles
from martloom.session import materialise, sized

SCOPE = ["platform_id", "product_line_id_filter"]
CUSTOMER = [*SCOPE, "customer_id"]

# Purchase-cycle multiples that bound each activity status.
CYCLE_BOUNDS = {"E0": 2.0, "S1": 2.5, "S2": 3.0}

# Published BG/NBD estimates (Fader, Hardie and Lee 2005), time in weeks.
BGNBD = {"r": 0.243, "alpha": 4.414, "a": 0.793, "b": 2.426}

SALES_COLUMNS = ["customer_id", "payment_time", "lineproduct_price", "platform_id", "product_line_id"]


def check_sales(sales: DataFrame, platforms: list[str]) -> DataFrame:
    """Input gate in one pass: one row per rule with status and actual value."""
    missing = [c for c in SALES_COLUMNS if c not in sales.columns]
    if missing:
        raise ValueError(f"sales lacks columns {missing}")
    row = sales.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.coalesce(~F.col("platform_id").isin(platforms), F.lit(True))).alias("foreign"),
    )
    rules = F.array(
        F.struct(F.lit("row_count").alias("check"), (F.col("rows") >= 1).alias("ok"), F.col("rows").alias("actual")),
        F.struct(F.lit("distinct_customers").alias("check"), (F.col("customers") >= 1).alias("ok"), F.col("customers").alias("actual")),
        F.struct(F.lit("foreign_platform").alias("check"), (F.col("foreign") == 0).alias("ok"), F.col("foreign").alias("actual")),
    )
    return row.select(F.explode(rules).alias("r")).select(
        "r.check", F.when(F.col("r.ok"), "PASS").otherwise("FAIL").alias("status"), "r.actual"
    )


def customer_by_date(sales: DataFrame) -> DataFrame:
    """Spend and transactions per customer and day, for each line and for `all`."""
    day = sales.select(
        "platform_id", "product_line_id", "customer_id", F.to_date("payment_time").alias("date"), "payment_time", "lineproduct_price"
    )
    return (
        with_rollup_all(day, "product_line_id", "product_line_id_filter")
        .groupBy(*CUSTOMER, "date")
        .agg(
            exact_sum("lineproduct_price").alias("sum_spent_by_date"),
            F.count(F.lit(1)).alias("count_transactions_by_date"),
            F.min("payment_time").alias("min_time_by_date"),
        )
    )


def by_customer(by_date: DataFrame) -> DataFrame:
    """Totals per customer; `ni` counts purchase days, `ipt` is the mean gap between them."""
    return by_date.groupBy(*CUSTOMER).agg(*_totals())


def _totals() -> list[Column]:
    days = F.datediff(F.max("date"), F.min("date"))
    return [
        exact_sum("sum_spent_by_date").alias("sum_sales_by_customer"),
        F.sum("count_transactions_by_date").alias("sum_transactions_by_customer"),
        F.when(F.count(F.lit(1)) > 1, days / (F.count(F.lit(1)) - 1)).alias("ipt"),
        F.count(F.lit(1)).alias("ni"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ]


def rfm(customers: DataFrame, asof: Column, *more: Column) -> DataFrame:
    return customers.select(
        *CUSTOMER,
        F.datediff(asof, F.col("last_date")).alias("r_value"),
        F.col("ni").alias("f_value"),
        (F.col("sum_sales_by_customer") / F.col("ni")).alias("m_value"),
        "ipt",
        F.datediff(asof, F.col("first_date")).alias("customer_tenure_days"),
        F.col("sum_sales_by_customer").alias("total_spent"),
        *more,
    )


SCORE_TILES = {"_recency": ("r_value", 5), "dna_f_score": ("f_value", 5), "dna_m_score": ("m_value", 5)}
TIER_TILES = {"_tier": ("total_spent", 3)}


def _name_tiles(tiled: DataFrame) -> DataFrame:
    """Turn raw tiles into a recency score (recent is high) and a tier label."""
    if "_recency" in tiled.columns:
        tiled = tiled.withColumn("dna_r_score", F.lit(6) - F.col("_recency")).drop("_recency")
    if "_tier" in tiled.columns:
        tiled = tiled.withColumn("value_tier", F.element_at(F.array(F.lit("Low"), F.lit("Medium"), F.lit("High")), F.col("_tier"))).drop("_tier")
    return tiled


def rfm_scores(table: DataFrame) -> DataFrame:
    """Quintiles in each scope; a recent purchase scores high."""
    return _name_tiles(with_tiles(table, SCOPE, SCORE_TILES, "customer_id"))


def purchase_cycle(table: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """Mean interpurchase time of repeat customers per scope."""
    return table.groupBy(*scope).agg(exact_mean("ipt").alias("mean_cycle"))


def with_status(table: DataFrame, bounds: dict[str, float] = CYCLE_BOUNDS) -> DataFrame:
    """N new, E0 active, S1 drowsy, S2 half asleep, S3 asleep, from recency in mean cycles."""
    r, mu = F.col("r_value"), F.col("mean_cycle")
    within = r <= bounds["E0"] * mu
    single = F.col("f_value") == 1
    status = (
        F.when(within & single, "N")
        .when(within, "E0")
        .when(r <= bounds["S1"] * mu, "S1")
        .when(r <= bounds["S2"] * mu, "S2")
        .when(mu.isNull() & single, "N")
        .otherwise("S3")
    )
    return table.withColumn("nes_status", status)


def nes_status(table: DataFrame, bounds: dict[str, float] = CYCLE_BOUNDS, scope: list[str] = SCOPE) -> DataFrame:
    """Status of every customer against the mean purchase cycle of the scope.

    The input is written once because it is read twice, for the cycle and for the rows; one row
    per customer is far smaller than the facts behind it.
    """
    table = materialise(table, "customers")
    return with_status(table.join(sized(purchase_cycle(table, scope)), scope), bounds)


def intervals(by_date: DataFrame, keys: list[str] = CUSTOMER) -> DataFrame:
    """Integer sums over the gaps between purchase days; a customer has one row per day at most."""
    return _with_gaps(by_date, keys).groupBy(*keys).agg(*_gap_sums())


def _with_gaps(by_date: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("date")
    return by_date.withColumns({"t": F.datediff("date", F.lag("date").over(w)).cast("long"), "i": F.row_number().over(w) - 1})


def _gap_sums() -> list[Column]:
    return [
        F.count("t").alias("n_gaps"),
        F.sum("t").alias("sum_t"),
        F.sum(F.col("i") * F.col("t")).alias("sum_it"),
        F.sum(F.col("t") * F.col("t")).alias("sum_tt"),
    ]


def _activity() -> list[Column]:
    n = F.col("n_gaps")
    mle, wmle = F.col("sum_t") / n, F.col("sum_it") / (n * (n + 1) / 2)
    mean = F.col("sum_t") / n
    variance = (F.col("sum_tt") - F.col("sum_t") * F.col("sum_t") / n) / (n - 1)
    return [
        F.when(n >= 1, (mle - wmle) / mle).alias("cai"),
        F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0))) / mean).alias("gap_variation"),
    ]


def cai(by_date: DataFrame) -> DataFrame:
    """Activity index: (plain mean gap - order-weighted mean gap) / plain mean gap."""
    return intervals(by_date).select(*CUSTOMER, "n_gaps", *_activity())


def _gauss_series(p: Column, q: Column, c: Column, z: Column) -> Column:
    """Gauss hypergeometric series for 0 <= z < 1, in the transformed form that converges fastest."""

    def total(p: pd.Series, q: pd.Series, c: pd.Series, z: pd.Series) -> pd.Series:
        u, v = (c - p).to_numpy(), (c - q).to_numpy()
        below, at = c.to_numpy(), z.to_numpy()
        term = np.ones(len(at))
        run = term.copy()
        # every element runs until its terms no longer count; below 1 the terms always fade
        live = np.isfinite(u) & np.isfinite(v) & np.isfinite(below) & (at < 1)
        run[~live] = np.nan
        j = 0
        while live.any():
            term[live] = (term * (u + j) * (v + j) / (below + j) / (j + 1) * at)[live]
            run[live] += term[live]
            live &= np.abs(term) > 1e-15 * np.abs(run)
            j += 1
        return pd.Series(run * (1 - at) ** (below - p.to_numpy() - q.to_numpy()))

    return F.pandas_udf(total, "double")(p, q, c, z)


def p_alive_clv(table: DataFrame, horizon_weeks: float = 52.0, params: dict[str, float | Column] = BGNBD) -> DataFrame:
    """BG/NBD probability of being active and expected value over the horizon; parameters may be columns."""
    r, alpha, a, b = (F.lit(params[k]) for k in ("r", "alpha", "a", "b"))
    x = (F.col("f_value") - 1).cast("double")
    t_x = (F.col("customer_tenure_days") - F.col("r_value")) / 7.0
    age = F.col("customer_tenure_days") / 7.0
    drop = F.when(x > 0, a / (b + x - 1) * F.pow((alpha + age) / (alpha + t_x), r + x)).otherwise(0.0)
    series = _gauss_series(r + x, b + x, a + b + x - 1, horizon_weeks / (alpha + age + horizon_weeks))
    grown = 1 - F.pow((alpha + age) / (alpha + age + horizon_weeks), r + x) * series
    expected = (a + b + x - 1) / (a - 1) * grown / (1 + drop)
    return (
        table.withColumn("p_alive", 1 / (1 + drop))
        .withColumn("expected_purchases", expected)
        .withColumn("clv", F.col("expected_purchases") * F.col("m_value"))
    )


def fitted_clv(table: DataFrame, horizon_weeks: float = 52.0, scope: list[str] = SCOPE, penalty: float = 0.001) -> DataFrame:
    """p_alive, expected_purchases and clv by the parameters fitted for each customer's own scope.

    Scopes without a fit (too few customers who came back) get nulls and say so in `fit_status`.
    """
    table = materialise(table, "customers")
    fits = sized(fit_lifetime(table, scope, penalty=penalty).select(*scope, *PARAMETERS, "fit_status"))
    scored = p_alive_clv(table.join(fits, scope), horizon_weeks, {p: F.col(p) for p in PARAMETERS})
    return scored.drop(*PARAMETERS)


def value_tier(table: DataFrame) -> DataFrame:
    return _name_tiles(with_tiles(table, SCOPE, TIER_TILES, "customer_id"))


def with_segment(table: DataFrame) -> DataFrame:
    return table.withColumn("dna_segment", F.concat_ws("_", "nes_status", "value_tier"))


def segments(table: DataFrame) -> DataFrame:
    """`dna_segment` = activity status and spend tercile."""
    return with_segment(value_tier(table))


def customer_dna(by_date: DataFrame, asof: Column) -> DataFrame:
    """One row per customer and scope with every customer measure; all tiles share one ordered pass."""
    # totals and gaps of a customer come from one shuffle of the purchase days; activity is known where all keys are
    customers = _with_gaps(by_date, CUSTOMER).groupBy(*CUSTOMER).agg(*_totals(), *_gap_sums())
    known = F.concat(*[F.col(c).cast("string") for c in CUSTOMER]).isNotNull()
    active = [F.when(known, F.col(c)).alias(c) for c in ("cai", "gap_variation")]
    base = materialise(rfm(customers.select("*", *_activity()), asof, *active), "rfm")
    tiled = with_tiles(base, SCOPE, {**SCORE_TILES, **TIER_TILES}, "customer_id")
    cycle = sized(purchase_cycle(base))
    scored = p_alive_clv(with_segment(with_status(_name_tiles(tiled).join(cycle, SCOPE))))
    return scored.select(*[c for c in scored.columns if c not in ("cai", "gap_variation")], "cai", "gap_variation")


def customer_profile(sales: DataFrame) -> DataFrame:
    """Latest known name and e-mail per customer and platform."""
    w = Window.partitionBy("customer_id", "platform_id").orderBy(
        F.col("payment_time").desc(), F.col("order_id").desc(), "buyer_name", "email"
    )
    return (
        sales.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("customer_id", "platform_id", "buyer_name", "email")
    )


def dna_views(dna: DataFrame, profile: DataFrame) -> dict[str, DataFrame]:
    """Analytics, segment and statistics views; also registered as temp views."""
    per_scope = dna.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("scope_customers"))
    views = {
        "v_customer_dna_analytics": dna.join(profile, ["customer_id", "platform_id"], "left"),
        "v_customer_segments": dna.select(*CUSTOMER, "nes_status", "dna_segment", "cai", "value_tier"),
        "v_segment_statistics": dna.groupBy(*SCOPE, "dna_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            exact_mean("r_value").alias("avg_r"),
            exact_mean("f_value").alias("avg_f"),
            exact_mean("m_value").alias("avg_m"),
        )
        .join(per_scope, SCOPE)
        .withColumn("share", F.col("customers") / F.col("scope_customers"))
        .drop("scope_customers"),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def _metrics_long(table: DataFrame, metrics: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return (
        table.select(*SCOPE, F.explode(pairs).alias("p")).select(*SCOPE, "p.metric", "p.value").filter(F.col("value").isNotNull())
    )


def distribution(table: DataFrame, metrics: list[str], bins: int = 500) -> DataFrame:
    """Cumulative share on distinct values, thinned to the top value of each equal-share bin."""
    counted = _metrics_long(table, metrics).groupBy(*SCOPE, "metric", "value").agg(F.count(F.lit(1)).alias("n"))
    run = running_total(counted, [*SCOPE, "metric"], ["value"], "n", "upto", "size")
    binned = run.withColumn("bin", F.ceil(F.col("upto") * bins / F.col("size")).cast("int"))
    return binned.groupBy(*SCOPE, "metric", "bin").agg(
        F.max("value").alias("value"), (F.max("upto") / F.max("size")).alias("ecdf")
    )


def histogram(table: DataFrame, metrics: list[str], bins: int = 30) -> DataFrame:
    long = _metrics_long(table, metrics)
    keys = [*SCOPE, "metric"]
    counted = materialise(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")), "counted")
    span = counted.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    at = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    return (
        counted.join(sized(span), keys)
        .withColumn("bin", F.when(F.col("hi") > F.col("lo"), at).otherwise(0).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.sum("n").alias("n"))
    )


def category_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("label")) for c in columns])
    return (
        table.select(*SCOPE, F.explode(pairs).alias("p"))
        .groupBy(*SCOPE, F.col("p.category").alias("category"), F.col("p.label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def summary_stats(table: DataFrame, metrics: list[str]) -> DataFrame:
    keys = [*SCOPE, "metric"]
    long = materialise(_metrics_long(table, metrics), "metrics")
    moments = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        exact_mean("value").alias("mean"),
        F.stddev("value").alias("sd"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(quantiles(long, keys, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}), keys)


def rsv(table: DataFrame) -> DataFrame:
    """Risk, stability and value terciles; `customer_type` joins the three, 27 classes.

    Needs r_value, f_value, m_value, mean_cycle and gap_variation. A customer without a gap
    variation has the least stability.
    """
    base = (
        table.withColumn("risk_value", F.col("r_value") / F.col("mean_cycle"))
        .withColumn("unstable_value", F.coalesce("gap_variation", F.lit(1e9)))
        .withColumn("worth_value", F.col("m_value") * F.col("f_value"))
    )
    tiles = {"_r": ("risk_value", 3), "_s": ("unstable_value", 3), "_v": ("worth_value", 3)}
    tiled = with_tiles(base, SCOPE, tiles, "customer_id")
    label = lambda c, names: F.element_at(F.array(*[F.lit(n) for n in names]), F.col(c))
    return (
        tiled.withColumn("risk", label("_r", ["LowRisk", "MidRisk", "HighRisk"]))
        .withColumn("stability", label("_s", ["Stable", "MidStable", "Unstable"]))
        .withColumn("value", label("_v", ["LowValue", "MidValue", "HighValue"]))
        .withColumn("customer_type", F.concat_ws("-", "risk", "stability", "value"))
        .drop("_r", "_s", "_v")
    )


def cross_category(by_date: DataFrame, sentinels: tuple[str, ...] = ("all", "unclassified", "UNKNOWN", "")) -> DataFrame:
    """Per platform: customers by number of real lines and the share with two or more."""
    line = F.trim("product_line_id_filter")
    per = (
        by_date.filter(line.isNotNull() & ~line.isin(*sentinels))
        .select("platform_id", "customer_id", "product_line_id_filter")
        .groupBy("platform_id", "customer_id")
        .agg(F.count_distinct("product_line_id_filter").alias("k"))
    )
    return per.groupBy("platform_id").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("k") == 1).alias("one_line"),
        F.count_if(F.col("k") == 2).alias("two_lines"),
        F.count_if(F.col("k") >= 3).alias("three_or_more_lines"),
        (F.count_if(F.col("k") >= 2) / F.count(F.lit(1))).alias("cross_rate"),
    )


PERIODS = {"now": 0, "month_ago": -1, "quarter_ago": -3, "year_ago": -12}


def dna_snapshots(by_date: DataFrame, asof: Column, periods: dict[str, int] = PERIODS) -> DataFrame:
    """Customer measures as they stood at each cutoff, all cutoffs in one plan.

    One aggregate per customer holds the measures of all cutoffs side by side, so no purchase day is repeated
    for each of them; only finished customers are spread over the cutoffs that saw a purchase.
    """
    day, spent = F.col("date"), F.col("sum_spent_by_date").cast(MONEY)
    cutoff = {p: F.add_months(asof, m) for p, m in periods.items()}
    measures = [F.min("date").alias("_first")]
    for i, cut in enumerate(cutoff.values()):
        seen = day <= cut
        measures += [F.max(F.when(seen, day)).alias(f"_last{i}"), F.count_if(seen).alias(f"_n{i}"), F.sum(F.when(seen, spent)).alias(f"_s{i}")]
    sides = [
        F.struct(F.lit(p).alias("period"), cut.alias("cutoff"), F.col(f"_last{i}").alias("last"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").cast("double").alias("spent"))
        for i, (p, cut) in enumerate(cutoff.items())
    ]
    side = by_date.groupBy(*CUSTOMER).agg(*measures).withColumn("_c", F.explode(F.filter(F.array(*sides), lambda c: c["n"] > 0)))
    n, last = F.col("_c.n"), F.col("_c.last")
    base = side.select(
        F.col("_c.period").alias("period"),
        F.col("_c.cutoff").alias("cutoff"),
        *CUSTOMER,
        n.alias("f_value"),
        (F.col("_c.spent") / n).alias("m_value"),
        # the first day of all is the first one of every cutoff that saw a purchase
        F.when(n > 1, F.datediff(last, "_first") / (n - 1)).alias("ipt"),
        F.datediff("_c.cutoff", last).alias("r_value"),
    )
    return nes_status(base, scope=["period", *SCOPE])


def nes_transitions(snapshots: DataFrame, periods: list[str] = list(PERIODS)) -> DataFrame:
    """Status changes between consecutive cutoffs, with the asleep-to-active rate.

    One aggregate per customer puts all cutoffs side by side, so no self-join is needed.
    """
    newest_first = list(periods)
    side = snapshots.groupBy(*CUSTOMER).agg(
        *[F.max(F.when(F.col("period") == p, F.col("nes_status"))).alias(p) for p in newest_first]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(old).alias("from_period"), F.lit(new).alias("to_period"), F.col(old).alias("from_status"), F.col(new).alias("to_status"))
            for new, old in zip(newest_first, newest_first[1:])
        ]
    )
    step = [*SCOPE, "from_period", "to_period"]
    moved = (
        side.select(*SCOPE, F.explode(pairs).alias("p"))
        .select(*SCOPE, "p.*")
        .filter(F.col("from_status").isNotNull() & F.col("to_status").isNotNull())
        .groupBy(*step, "from_status", "to_status")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # the matrix has at most 25 cells per step
    w = Window.partitionBy(*step)
    asleep = F.col("from_status").isin("S1", "S2", "S3")
    woke = F.sum(F.when(asleep & (F.col("to_status") == "E0"), F.col("customers")).otherwise(0)).over(w)
    slept = F.sum(F.when(asleep, F.col("customers")).otherwise(0)).over(w)
    return moved.withColumn("awakening_rate", F.when(slept > 0, woke / slept))


def dna_snapshot_summary(dna: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return dna.groupBy(*SCOPE).agg(
        n.alias("n_customers"),
        exact_mean("clv", MONEY).alias("mean_clv"),
        exact_mean("p_alive").alias("mean_p_alive"),
        (100 * F.count_if(F.col("nes_status") == "E0") / n).alias("e0_pct"),
        (100 * F.count_if(F.col("nes_status").isin("S1", "S2", "S3")) / n).alias("sleeping_pct"),
    )
