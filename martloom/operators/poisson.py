"""Univariate Poisson regressions for every (product line, predictor) at once.

A one-predictor Poisson likelihood depends on the data only through counts and sums per distinct
predictor value. The job therefore compresses the observations to such levels with a partial
aggregate. Models with few levels are solved from them in one grouped pass; a model with more
levels than `MAX_LEVELS` is fitted by Newton rounds of distributed sums, so no model's levels are
ever gathered beyond that bound.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.sets import union_all
from martloom.session import materialise, sized

MODEL = ["product_line_id", "predictor"]
TOLERANCE = 1e-10  # of a Newton step
SETTLED = 1e-13  # relative change of the log-likelihood after which a fit that still moves has none

# Columns that are never predictors. Fixed values.
NOT_PREDICTORS = [
    "product_id", "item_id", "time", "date", "order_date", "sales", "sales_platform", "product_line_id", "product_line_name", "data_source",
    "filling_method", "filling_timestamp", "source_table", "processing_version", "enrichment_version",
]


def select_predictors(df: DataFrame, ids: list[str] = NOT_PREDICTORS) -> list[str]:
    """Numeric columns that are neither ids, metadata nor join residue."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    return [c for c, t in df.dtypes if c not in ids and not c.endswith((".x", ".y")) and t.startswith(numeric)]


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def to_long(df: DataFrame, predictors: list[str], y: str = "sales", exposure: str | None = None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(p).alias("predictor"), finite(F.col(p)).alias("x")) for p in predictors])
    keep = [F.col("product_line_id"), F.col(y).cast("double").alias("y")]
    keep += [F.col(exposure).cast("double").alias("exposure")] if exposure else [F.lit(1.0).alias("exposure")]
    return df.select(*keep, F.explode(pairs).alias("p")).select("product_line_id", "p.predictor", "p.x", "y", "exposure")


def _log_factorial(y: Column) -> Column:
    """ln(y!) by the Stirling series after a shift by eight."""
    z = y + 9
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    shift = sum((F.log(y + j) for j in range(1, 9)), F.lit(0.0))
    return series - shift


def compress(long: DataFrame) -> DataFrame:
    """Levels: one row per (model, x, exposure) with counts and sums; a null x is a level of its own."""
    y = F.col("y")
    return long.groupBy(*MODEL, "x", "exposure").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count("y").alias("n"),
        F.coalesce(F.sum("y"), F.lit(0.0)).alias("sum_y"),
        F.coalesce(F.sum(y * y), F.lit(0.0)).alias("sum_yy"),
        F.coalesce(F.sum(F.when(y > 0, y * F.log(y)).otherwise(0.0)), F.lit(0.0)).alias("sum_ylogy"),
        F.coalesce(F.sum(_log_factorial(y)), F.lit(0.0)).alias("sum_logfact"),
    )


def estimability(levels: DataFrame, min_rows: int = 3) -> DataFrame:
    """Why a model can or cannot be fitted, from the levels alone."""
    known, used = F.col("x").isNotNull(), F.col("x").isNotNull() & (F.col("n") > 0)
    per_x = levels.groupBy(*MODEL, "x").agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n"), F.sum("sum_y").alias("sum_y"))
    binary = (F.min(F.when(used, F.col("x"))) == 0) & (F.max(F.when(used, F.col("x"))) == 1) & (F.count_if(used) == 2)
    facts = per_x.groupBy(*MODEL).agg(
        F.sum(F.when(known, F.col("n_all")).otherwise(0)).alias("n_known"),
        F.count_if(known).alias("x_known"),
        F.sum(F.when(used, F.col("n")).otherwise(0)).alias("sample_size"),
        F.count_if(used).alias("n_levels"),
        F.sum(F.when(used, F.col("sum_y")).otherwise(0.0)).alias("total_y"),
        (binary & (F.min(F.when(used, F.col("sum_y"))) <= 0)).alias("zero_cell"),
    )
    reason = (
        F.when(F.col("n_known") == 0, "all_na_prefilter")
        .when(F.col("x_known") == 1, "constant_prefilter")
        .when(F.col("sample_size") < min_rows, "insufficient_rows")
        .when(F.col("n_levels") < 2, "constant_in_subset")
        .when((F.col("total_y") <= 0) | F.col("zero_cell"), "glm_error")
    )
    status = F.when(F.col("drop_reason").isNull(), "estimated").when(F.col("drop_reason").endswith("prefilter"), "dropped").otherwise("not_estimable")
    return (
        facts.withColumn("drop_reason", reason)
        .withColumn("estimation_status", status)
        .select(*MODEL, "sample_size", "n_levels", "estimation_status", "drop_reason")
    )


def predictor_ranges(levels: DataFrame) -> DataFrame:
    """Observed range per model; the multiplier maps the range to a 0..100 track."""
    used = levels.filter("x is not null and n > 0")
    spread = F.max("x") - F.min("x")
    return used.groupBy(*MODEL).agg(
        F.min("x").alias("predictor_min"),
        F.max("x").alias("predictor_max"),
        spread.alias("predictor_range"),
        ((F.min("x") == 0) & (F.max("x") == 1) & (F.count_if(~F.col("x").isin(0.0, 1.0)) == 0)).alias("predictor_is_binary"),
        F.when(spread > 0, 100 / spread).otherwise(100.0).alias("track_multiplier"),
    )


def _moments(levels: DataFrame) -> DataFrame:
    """Per model: totals and the weighted mean and deviation used to standardise x."""
    mean = F.sum(F.col("n") * F.col("x")) / F.sum("n")
    first = levels.groupBy(*MODEL).agg(
        F.sum("n").alias("n_obs"),
        F.sum("sum_y").alias("t0"),
        F.sum(F.col("n") * F.col("exposure")).alias("sum_e"),
        mean.alias("x_mean"),
        F.sum("sum_ylogy").alias("t_ylogy"),
        F.sum("sum_logfact").alias("t_logfact"),
        F.sum(F.col("sum_y") * F.log("exposure")).alias("t_yloge"),
    )
    spread = (
        levels.join(first.select(*MODEL, "x_mean"), MODEL)
        .groupBy(*MODEL)
        .agg(
            F.sqrt(F.sum(F.col("n") * F.pow(F.col("x") - F.col("x_mean"), 2)) / F.sum("n")).alias("x_sd"),
            F.sum((F.col("x") - F.col("x_mean")) * F.col("sum_y")).alias("_xy"),
        )
    )
    return first.join(spread, MODEL).withColumn("t1", F.col("_xy") / F.col("x_sd")).drop("_xy")


FIT_SCHEMA = (
    "product_line_id string, predictor string, a double, b double, rounds int, converged boolean, s0 double, s1 double, s2 double, pearson double"
)


def _two_valued(levels: DataFrame, moments: DataFrame) -> DataFrame:
    """Closed form for predictors with two values: each side's rate is its sum over its exposure."""
    x, e = F.col("x"), F.col("n") * F.col("exposure")
    sums = levels.groupBy(*MODEL).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum(x * F.col("sum_y")).alias("_xy"), F.sum(e).alias("_e"), F.sum(x * e).alias("_xe")
    )
    width = F.col("hi") - F.col("lo")
    y_hi, e_hi = (F.col("_xy") - F.col("lo") * F.col("t0")) / width, (F.col("_xe") - F.col("lo") * F.col("_e")) / width
    slope = F.log((y_hi / e_hi) / ((F.col("t0") - y_hi) / (F.col("_e") - e_hi))) / width
    level = F.log((F.col("t0") - y_hi) / (F.col("_e") - e_hi))
    params = (
        sums.join(moments, MODEL)
        .withColumn("_slope", slope)
        .select(*MODEL, "x_mean", "x_sd", (level + F.col("_slope") * (F.col("x_mean") - F.col("lo"))).alias("a"), (F.col("_slope") * F.col("x_sd")).alias("b"))
    )
    return params.join(_model_sums(levels, params), MODEL).select(
        *MODEL, "a", "b", F.lit(0).alias("rounds"), F.col("b").isNotNull().alias("converged"), "s0", "s1", "s2", "pearson"
    )


def _newton_rounds(levels: DataFrame, moments: DataFrame) -> DataFrame:
    """Newton steps as distributed sums; one tiny parameter table travels per round.

    A model is done when its step is small, when it has no step (singular), or when its likelihood
    no longer grows although its step is not small: then it has no finite maximum. The likelihood is
    concave and its steps are bounded, so every model gets done.
    """
    params = materialise(
        moments.select(
            *MODEL, "x_mean", "x_sd", "t0", "t1", F.log(F.col("t0") / F.col("sum_e")).alias("a"), F.lit(0.0).alias("b"),
            F.lit(0).alias("rounds"), F.lit(False).alias("converged"), F.lit(False).alias("done"), F.lit(None).cast("double").alias("likelihood"),
        ),
        "newton",
    )
    while not params.filter(~F.col("done")).isEmpty():
        sums = _model_sums(levels, params)
        det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
        stuck = ~F.coalesce((det > 0) & (det < float("inf")), F.lit(False))
        r0, r1 = F.col("t0") - F.col("s0"), F.col("t1") - F.col("s1")
        da, db = (F.col("s2") * r0 - F.col("s1") * r1) / det, (F.col("s0") * r1 - F.col("s1") * r0) / det
        largest = F.greatest(F.abs("_da"), F.abs("_db"))
        scale = F.least(F.lit(1.0), 3.0 / F.greatest(largest, F.lit(1e-300)))
        now = F.col("a") * F.col("t0") + F.col("b") * F.col("t1") - F.col("s0")
        flat = F.coalesce(F.abs(now - F.col("likelihood")) <= SETTLED * (F.abs(now) + 1), F.lit(False)) & (largest > 1e-3)
        stepped = (
            params.join(sums, MODEL)
            .withColumn("_stuck", stuck)
            .withColumn("_da", F.when(F.col("done") | F.col("_stuck"), 0.0).otherwise(da))
            .withColumn("_db", F.when(F.col("done") | F.col("_stuck"), 0.0).otherwise(db))
            .select(
                *MODEL, "x_mean", "x_sd", "t0", "t1", (F.col("a") + scale * F.col("_da")).alias("a"), (F.col("b") + scale * F.col("_db")).alias("b"),
                (F.col("rounds") + F.when(F.col("done"), 0).otherwise(1)).alias("rounds"),
                (F.col("converged") | (~F.col("done") & ~F.col("_stuck") & (largest < TOLERANCE))).alias("converged"),
                (F.col("done") | F.col("_stuck") | (largest < TOLERANCE) | flat).alias("done"),
                F.when(F.col("done"), F.col("likelihood")).otherwise(now).alias("likelihood"),
            )
        )
        params = materialise(stepped, "newton")
    return params.join(_model_sums(levels, params), MODEL).select(*MODEL, "a", "b", "rounds", "converged", "s0", "s1", "s2", "pearson")


def _model_sums(levels: DataFrame, params: DataFrame) -> DataFrame:
    z = (F.col("x") - F.col("x_mean")) / F.col("x_sd")
    rate = F.col("exposure") * F.exp(F.col("a") + F.col("b") * z)
    mu = F.col("n") * rate
    return (
        levels.join(params.select(*MODEL, "x_mean", "x_sd", "a", "b"), MODEL)
        .groupBy(*MODEL)
        .agg(
            F.sum(mu).alias("s0"),
            F.sum(mu * z).alias("s1"),
            F.sum(mu * z * z).alias("s2"),
            (F.sum(F.col("sum_yy") / rate) - 2 * F.sum("sum_y") + F.sum(mu)).alias("pearson"),
        )
    )


def _tail_coefficients(degree: int = 40) -> list[float]:
    """Chebyshev coefficients of ln(erfc(x) exp(x^2) (2 + x) / 2) in t = 2 / (2 + x)."""
    low = 2 / (2 + _TAIL_END)

    def scaled(u: np.ndarray) -> np.ndarray:
        t = low + (u + 1) / 2 * (1 - low)
        x = 2 / t - 2
        return np.array([math.log(math.erfc(v)) + v * v - math.log(w) for v, w in zip(x, t)])

    return [float(c) for c in np.polynomial.chebyshev.chebinterpolate(scaled, degree)]


_TAIL_END = 26.0  # erfc leaves the range of a double shortly after


def two_sided_p(z: Column) -> Column:
    """Two-sided normal tail as a column expression; Spark has no error function."""
    x = F.abs(z) / math.sqrt(2)
    low = 2 / (2 + _TAIL_END)
    t = 2 / (2 + x)
    u = (t - low) / (1 - low) * 2 - 1
    coefficients = _tail_coefficients()
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("dd"))
    down = F.array(*[F.lit(c) for c in reversed(coefficients[1:])])
    walk = F.aggregate(down, start, lambda s, c: F.struct((2 * u * s["d"] - s["dd"] + c).alias("d"), s["d"].alias("dd")))
    tail = t * F.exp(u * walk["d"] - walk["dd"] + coefficients[0] - x * x)
    return F.when(x >= _TAIL_END, 0.0).otherwise(F.least(tail, F.lit(1.0)))


def fit(levels: DataFrame, quasi: bool = False, min_rows: int = 3) -> DataFrame:
    """Coefficient table for all models of a compressed frame.

    `quasi` scales standard errors by the Pearson dispersion.
    """
    levels = materialise(levels, "levels")
    gate = sized(estimability(levels, min_rows))
    usable = levels.filter("x is not null and n > 0").join(gate.filter("estimation_status = 'estimated'").select(*MODEL), MODEL, "left_semi")
    sizes = usable.groupBy(*MODEL).agg(F.count_distinct("x").alias("_x"))
    kind = F.when(F.col("_x") == 2, "two").otherwise("many")
    moments = materialise(_moments(usable).join(sizes.select(*MODEL, kind.alias("_kind")), MODEL), "moments")
    solvers = {"two": _two_valued, "many": _newton_rounds}
    # two kinds at most; a kind without models plans no job
    present = [r[0] for r in moments.select("_kind").distinct().orderBy("_kind").collect()]
    parts = [solvers[k](usable.join(moments.filter(F.col("_kind") == k).select(*MODEL), MODEL), moments.filter(F.col("_kind") == k).drop("_kind")) for k in present]
    fitted = union_all(*parts) if parts else usable.sparkSession.createDataFrame([], FIT_SCHEMA)
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    dispersion = F.when(F.col("n_obs") > 2, F.col("pearson") / (F.col("n_obs") - 2))
    scale = F.sqrt(dispersion) if quasi else F.lit(1.0)
    eta_y = F.col("a") * F.col("t0") + F.col("b") * F.col("t1") + F.col("t_yloge")
    solved = (
        fitted.join(moments, MODEL)
        .withColumn("coefficient", F.col("b") / F.col("x_sd"))
        .withColumn("intercept", F.col("a") - F.col("b") * F.col("x_mean") / F.col("x_sd"))
        .withColumn("std_error", F.sqrt(F.col("s0") / det) / F.col("x_sd") * scale)
        .withColumn("z_value", F.col("coefficient") / F.col("std_error"))
        .withColumn("p_value", two_sided_p(F.col("z_value")))
        .withColumn("deviance", 2 * (F.col("t_ylogy") - eta_y - F.col("t0") + F.col("s0")))
        .withColumn("aic", -2 * (eta_y - F.col("s0") - F.col("t_logfact")) + 4)
        .withColumn("dispersion", dispersion)
        .select(*MODEL, "intercept", "coefficient", "std_error", "z_value", "p_value", "deviance", "aic", "dispersion", "converged", "rounds")
    )
    good = F.col("converged")
    half = 1.959963984540054 * F.col("std_error")
    values = {
        "incidence_rate_ratio": F.exp("coefficient"),
        "conf_low": F.col("coefficient") - half,
        "conf_high": F.col("coefficient") + half,
        "irr_conf_low": F.exp(F.col("coefficient") - half),
        "irr_conf_high": F.exp(F.col("coefficient") + half),
    }
    out = gate.join(solved, MODEL, "left").withColumns(values)
    failed = (F.col("estimation_status") == "estimated") & ~F.coalesce(good, F.lit(False))
    numbers = ["intercept", "coefficient", "std_error", "z_value", "p_value", "deviance", "aic", "dispersion", *values]
    return (
        out.withColumns({c: F.when(good, F.col(c)) for c in numbers})
        .withColumn("drop_reason", F.when(failed & (F.col("rounds") > 0), "not_converged").when(failed, "glm_error").otherwise(F.col("drop_reason")))
        .withColumn("estimation_status", F.when(failed, "not_estimable").otherwise(F.col("estimation_status")))
        .withColumn("convergence", F.when(good, "converged").otherwise("not_converged"))
        .drop("converged", "rounds", "n_levels")
        .join(predictor_ranges(levels), MODEL, "left")
    )


def poisson_univariate(df: DataFrame, predictors: list[str], y: str = "sales", exposure: str | None = None, quasi: bool = False) -> DataFrame:
    """`y ~ x` for every line and predictor, each on its own non-null rows."""
    return fit(compress(to_long(df, predictors, y, exposure)), quasi=quasi)


SENTINEL_PREDICTOR = "__no_data__"


def missing_reasons(lines: DataFrame, series: DataFrame, gate: DataFrame, date: str = "time", sales: str = "sales") -> DataFrame:
    """(product_line_id, drop_reason) of every line that no model can be fitted for, by the first thing it lacks."""
    wanted = lines.select("product_line_id").distinct()
    for column, reason in ((date, "no_date_column"), (sales, "no_sales_column")):
        if column not in series.columns:
            return wanted.withColumn("drop_reason", F.lit(reason))
    whole = F.col(date).isNotNull() & F.col(sales).isNotNull() & ~F.isnan(F.col(sales).cast("double"))
    rows = series.groupBy("product_line_id").agg(F.count_if(whole).alias("_valid"), F.count_if(whole & (F.col(sales) != 0)).alias("_sold"))
    models = gate.groupBy("product_line_id").agg(F.bool_or(F.col("estimation_status") == "estimated").alias("_any"))
    reason = (
        F.when(F.col("_valid").isNull(), "no_series")
        .when(F.col("_valid") == 0, "no_valid_rows")
        .when(F.col("_sold") == 0, "all_zero")
        .when(~F.coalesce("_any", F.lit(False)), "no_predictors")
    )
    joined = wanted.join(rows, "product_line_id", "left").join(models, "product_line_id", "left")
    return joined.select("product_line_id", reason.alias("drop_reason")).filter("drop_reason is not null")


def sentinels(lines: DataFrame, results: DataFrame, reason: str = "no_series", reasons: DataFrame | None = None) -> DataFrame:
    """Results plus one visible row for every line that has none, with its own reason where `reasons` has one."""
    absent = lines.select("product_line_id").distinct().join(results, "product_line_id", "left_anti")
    cause = F.lit(reason)
    if reasons is not None:
        absent = absent.join(reasons.select("product_line_id", F.col("drop_reason").alias("_reason")), "product_line_id", "left")
        cause = F.coalesce("_reason", F.lit(reason))
    rows = absent.select(
        "product_line_id", F.lit(SENTINEL_PREDICTOR).alias("predictor"), F.lit("not_estimable").alias("estimation_status"), cause.alias("drop_reason")
    )
    return results.unionByName(rows, allowMissingColumns=True)


def analyzability_audit(gate: DataFrame) -> DataFrame:
    return gate.filter("estimation_status <> 'estimated'").select(*MODEL, "estimation_status", "drop_reason", "sample_size")


def significance(results: DataFrame) -> DataFrame:
    """Per line: models fitted, not fitted and significant at two levels."""
    return results.groupBy("product_line_id").agg(
        F.count_if(F.col("estimation_status") == "estimated").alias("n_estimated"),
        F.count_if(F.col("estimation_status") != "estimated").alias("n_not_estimated"),
        F.count_if(F.col("p_value") < 0.05).alias("n_p05"),
        F.count_if(F.col("p_value") < 0.001).alias("n_p001"),
    )


def data_version(series: DataFrame, date: str) -> DataFrame:
    """Latest day and covered span per line."""
    return series.groupBy("product_line_id").agg(F.max(date).alias("data_version"), (F.datediff(F.max(date), F.min(date)) + 1).alias("span_days"))
