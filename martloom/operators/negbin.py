"""Negative-binomial regressions `y ~ x` with an exposure offset, for every (product line, predictor) at once.

Variance mu + mu^2 / theta. The likelihood needs the counts and sums of y for each level (x, exposure), and
the histogram of y for the terms in gamma(y + theta); both are partial aggregates. Every round sums score and
information of all open models; intercept and slope take a scoring step, ln(theta) a Newton step on its
profile, the two being orthogonal in expectation. One row per model travels from round to round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.poisson import MODEL, two_sided_p
from martloom.session import materialise

TOLERANCE = 1e-9  # of a step
ROUNDS = 100
MOST_THETA = 1e7  # beyond it the model is a Poisson model


def _shifted(z: Column) -> tuple[Column, list[Column]]:
    return z + 8, [z + j for j in range(8)]


def log_gamma(z: Column) -> Column:
    """ln gamma of a positive column: Stirling series after a shift by eight; so the two below."""
    w, below = _shifted(z)
    series = (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + 1 / (12 * w) - 1 / (360 * w * w * w) + 1 / (1260 * F.pow(w, F.lit(5.0))) - 1 / (1680 * F.pow(w, F.lit(7.0)))
    return series - sum((F.log(v) for v in below), F.lit(0.0))


def digamma(z: Column) -> Column:
    w, below = _shifted(z)
    q = 1 / (w * w)
    return F.log(w) - 0.5 / w - q * (F.lit(1 / 12) - q * (F.lit(1 / 120) - q / 252)) - sum((1 / v for v in below), F.lit(0.0))


def trigamma(z: Column) -> Column:
    w, below = _shifted(z)
    q = 1 / (w * w)
    return 1 / w + 0.5 * q + q / w * (F.lit(1 / 6) - q * (F.lit(1 / 30) - q / 42)) + sum((1 / (v * v) for v in below), F.lit(0.0))


def histogram(long: DataFrame) -> DataFrame:
    """(model, y) -> rows with a known predictor."""
    used = long.filter("x is not null and y is not null")
    return used.groupBy(*MODEL, "y").agg(F.count(F.lit(1)).alias("n_y"))


def _level_sums(levels: DataFrame, params: DataFrame) -> DataFrame:
    theta = F.exp("lt")
    z = (F.col("x") - F.col("x_mean")) / F.col("x_sd")
    mu = F.col("exposure") * F.exp(F.col("a") + F.col("b") * z)
    n, s = F.col("n"), F.col("sum_y")
    left, info = (s - n * mu) * theta / (theta + mu), n * mu * theta / (theta + mu)
    return (
        levels.join(params.select(*MODEL, "x_mean", "x_sd", "a", "b", "lt"), MODEL)
        .groupBy(*MODEL)
        .agg(
            F.sum(left).alias("g0"),
            F.sum(left * z).alias("g1"),
            F.sum(info).alias("i0"),
            F.sum(info * z).alias("i1"),
            F.sum(info * z * z).alias("i2"),
            F.sum(n).alias("n_obs"),
            F.sum(n * F.log(mu + theta) + (s + n * theta) / (mu + theta)).alias("u1"),
            F.sum(2 * n / (mu + theta) - (s + n * theta) / ((mu + theta) * (mu + theta))).alias("u2"),
            F.sum(s * F.log(mu) - (s + n * theta) * F.log(mu + theta)).alias("l1"),
        )
    )


def _count_sums(counts: DataFrame, params: DataFrame) -> DataFrame:
    z = F.col("y") + F.exp("lt")
    return (
        counts.join(params.select(*MODEL, "lt"), MODEL)
        .groupBy(*MODEL)
        .agg(
            F.sum(F.col("n_y") * digamma(z)).alias("d1"),
            F.sum(F.col("n_y") * trigamma(z)).alias("d2"),
            F.sum(F.col("n_y") * (log_gamma(z) - log_gamma(F.col("y") + 1))).alias("l2"),
        )
    )


def _start(levels: DataFrame, first: DataFrame) -> DataFrame:
    """Standardised Poisson coefficients and the moment estimate of theta."""
    mean = F.sum(F.col("n") * F.col("x")) / F.sum("n")
    spread = F.sqrt(F.greatest(F.sum(F.col("n") * F.col("x") * F.col("x")) / F.sum("n") - mean * mean, F.lit(0.0)))
    shape = levels.groupBy(*MODEL).agg(mean.alias("x_mean"), spread.alias("x_sd"))
    mu = F.col("exposure") * F.exp(F.col("intercept") + F.col("coefficient") * F.col("x"))
    n = F.col("n")
    over = F.sum(F.col("sum_yy") - 2 * mu * F.col("sum_y") + n * mu * mu - n * mu)
    theta = levels.join(first, MODEL).groupBy(*MODEL).agg((F.sum(n * mu * mu) / F.when(over > 0, over)).alias("_theta"))
    return shape.join(first, MODEL).join(theta, MODEL).select(
        *MODEL, "x_mean", "x_sd",
        (F.col("intercept") + F.col("coefficient") * F.col("x_mean")).alias("a"),
        (F.col("coefficient") * F.col("x_sd")).alias("b"),
        F.log(F.coalesce("_theta", F.lit(1e3))).alias("lt"),
        F.lit(0).alias("rounds"), F.lit(False).alias("done"), F.lit(False).alias("converged"),
    )


def fit_negbin(levels: DataFrame, counts: DataFrame, first: DataFrame) -> DataFrame:
    """Coefficients of the models in `first` (model, intercept, coefficient of the Poisson fit).

    `levels` are compressed levels, `counts` histograms of y. Returns model, nb_intercept, nb_coefficient,
    nb_std_error, theta, nb_log_likelihood and nb_converged (false where theta has no finite value).
    """
    first = materialise(first.select(*MODEL, "intercept", "coefficient"), "negbin-models")
    levels = materialise(levels.filter("x is not null and n > 0").join(first.select(*MODEL), MODEL, "left_semi"), "negbin-levels")
    counts = materialise(counts.join(first.select(*MODEL), MODEL, "left_semi"), "negbin-counts")
    params = materialise(_start(levels, first), "negbin")
    while not params.filter(~F.col("done")).isEmpty():
        open_models = params.filter(~F.col("done"))
        sums = _level_sums(levels, open_models).join(_count_sums(counts, open_models), MODEL)
        theta = F.exp("lt")
        det = F.col("i0") * F.col("i2") - F.col("i1") * F.col("i1")
        da = (F.col("i2") * F.col("g0") - F.col("i1") * F.col("g1")) / det
        db = (F.col("i0") * F.col("g1") - F.col("i1") * F.col("g0")) / det
        slope = F.col("d1") - F.col("n_obs") * digamma(theta) + F.col("n_obs") * (F.col("lt") + 1) - F.col("u1")
        bend = F.col("d2") - F.col("n_obs") * trigamma(theta) + F.col("n_obs") / theta - F.col("u2")
        # on the log scale; where the profile is not concave a short step uphill is taken
        log_slope, log_bend = theta * slope, theta * theta * bend + theta * slope
        dt = F.when(log_bend < 0, -log_slope / log_bend).otherwise(F.signum(log_slope))
        bounded = lambda step: F.greatest(F.least(step, F.lit(2.0)), F.lit(-2.0))
        moved = open_models.join(sums, MODEL).select(
            *MODEL, "x_mean", "x_sd", "a", "b", "lt", "rounds", bounded(da).alias("_a"), bounded(db).alias("_b"), bounded(dt).alias("_t")
        )
        size = F.greatest(F.abs("_a"), F.abs("_b"), F.abs("_t"))
        fine = F.coalesce(size < TOLERANCE, F.lit(False))
        lost = size.isNull() | F.isnan(size) | (F.col("lt") > math.log(MOST_THETA)) | (F.col("rounds") + 1 >= ROUNDS)
        stepped = moved.select(
            *MODEL, "x_mean", "x_sd", (F.col("a") + F.col("_a")).alias("a"), (F.col("b") + F.col("_b")).alias("b"), (F.col("lt") + F.col("_t")).alias("lt"),
            (F.col("rounds") + 1).alias("rounds"), (fine | lost).alias("done"), (fine & ~lost).alias("converged"),
        )
        params = materialise(stepped.unionByName(params.filter("done")), "negbin")
    sums = _level_sums(levels, params).join(_count_sums(counts, params), MODEL)
    theta = F.exp("lt")
    det = F.col("i0") * F.col("i2") - F.col("i1") * F.col("i1")
    value = F.col("l1") + F.col("l2") + F.col("n_obs") * (theta * F.col("lt") - log_gamma(theta))
    return params.join(sums, MODEL).select(
        *MODEL,
        (F.col("a") - F.col("b") * F.col("x_mean") / F.col("x_sd")).alias("nb_intercept"),
        (F.col("b") / F.col("x_sd")).alias("nb_coefficient"),
        (F.sqrt(F.col("i0") / det) / F.col("x_sd")).alias("nb_std_error"),
        theta.alias("theta"),
        value.alias("nb_log_likelihood"),
        F.col("converged").alias("nb_converged"),
    )


def with_fallback(results: DataFrame, levels: DataFrame, counts: DataFrame, limit: float) -> DataFrame:
    """Quasi-Poisson results, refitted where the Pearson dispersion exceeds `limit`.

    `family_used` says which family a row's numbers come from; `theta` is null for quasi-Poisson. A model
    whose fallback has no finite theta keeps its quasi-Poisson numbers.
    """
    results = materialise(results, "quasi")
    wild = results.filter((F.col("estimation_status") == "estimated") & (F.col("dispersion") > limit))
    refit = materialise(fit_negbin(levels, counts, wild), "negbin-fits").filter("nb_converged")
    joined = results.join(refit, MODEL, "left")
    used = F.col("theta").isNotNull()
    half = 1.959963984540054
    joined = joined.withColumns(
        {
            "intercept": F.coalesce("nb_intercept", "intercept"),
            "coefficient": F.coalesce("nb_coefficient", "coefficient"),
            "std_error": F.coalesce("nb_std_error", "std_error"),
        }
    ).withColumn("z_value", F.col("coefficient") / F.col("std_error"))
    low, high = F.col("coefficient") - half * F.col("std_error"), F.col("coefficient") + half * F.col("std_error")
    return joined.withColumns(
        {
            "p_value": F.when(used, two_sided_p(F.col("z_value"))).otherwise(F.col("p_value")),
            "incidence_rate_ratio": F.exp("coefficient"),
            "conf_low": low,
            "conf_high": high,
            "irr_conf_low": F.exp(low),
            "irr_conf_high": F.exp(high),
            # deviance and AIC belong to the Poisson likelihood
            "deviance": F.when(~used, F.col("deviance")),
            "aic": F.when(used, -2 * F.col("nb_log_likelihood") + 6).otherwise(F.col("aic")),
            "family_used": F.when(used, "negative_binomial").when(F.col("estimation_status") == "estimated", "quasipoisson"),
        }
    ).drop("nb_intercept", "nb_coefficient", "nb_std_error", "nb_log_likelihood", "nb_converged")
