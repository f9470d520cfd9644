"""Negative-binomial fallback against a plain maximiser of the raw likelihood."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators.market import market_model
from martloom.operators.negbin import digamma, fit_negbin, histogram, log_gamma, trigamma
from martloom.operators.poisson import compress, fit
from martloom.plans.newton import digamma_sql, normal_tail_sql, trigamma_sql


def simulated(seed, n, a, b, theta, binary=False):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2, n).astype(float) if binary else rng.integers(0, 6, n).astype(float)
    e = rng.integers(1, 13, n).astype(float)
    mu = e * np.exp(a + b * x)
    y = rng.poisson(rng.gamma(theta, mu / theta)) if theta else rng.poisson(mu)
    return x, y.astype(float), e


def likelihood(x, y, e, a, b, theta):
    mu = e * np.exp(a + b * x)
    lg = np.vectorize(math.lgamma)
    return float(np.sum(lg(y + theta) - math.lgamma(theta) - lg(y + 1) + theta * math.log(theta) + y * np.log(mu) - (y + theta) * np.log(mu + theta)))


def climbed(x, y, e, start):
    """Coordinate steps that shrink until none gains: slow and plain."""
    best, at, steps = likelihood(x, y, e, *start[:2], math.exp(start[2])), list(start), [0.1, 0.1, 0.1]
    while max(steps) > 1e-7:
        for i in range(3):
            for s in (steps[i], -steps[i]):
                moved = list(at)
                moved[i] += s
                value = likelihood(x, y, e, moved[0], moved[1], math.exp(moved[2]))
                if value > best:
                    best, at, steps[i] = value, moved, steps[i] * 1.5
                    break
            else:
                steps[i] *= 0.5
    return at, best


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    for line, (seed, a, b, theta, binary) in {"A": (1, 0.5, 0.3, 1.5, False), "B": (2, 2.0, -0.4, 4.0, True), "C": (3, 1.0, 0.2, 0, False)}.items():
        x, y, e = simulated(seed, 400, a, b, theta, binary)
        rows += [(line, "x", float(i), float(j), float(k), bool(n % 2)) for n, (i, j, k) in enumerate(zip(x, y, e))]
    rows += [("A", "x", None, 3.0, 1.0, True), ("A", "x", 2.0, None, 1.0, True)]
    return spark.createDataFrame(rows, "product_line_id string, predictor string, x double, y double, exposure double, is_own boolean").cache()


def test_fit_agrees_with_a_plain_maximiser(frame):
    levels = compress(frame)
    first = fit(levels, quasi=True).filter("product_line_id != 'C'")
    found = {r["product_line_id"]: r for r in fit_negbin(levels, histogram(frame), first).collect()}
    for line, (seed, a, b, theta, binary) in {"A": (1, 0.5, 0.3, 1.5, False), "B": (2, 2.0, -0.4, 4.0, True)}.items():
        x, y, e = simulated(seed, 400, a, b, theta, binary)
        at, best = climbed(x, y, e, [a, b, math.log(theta)])
        r = found[line]
        assert r["nb_converged"]
        assert r["nb_log_likelihood"] == pytest.approx(best, rel=1e-8)
        assert (r["nb_intercept"], r["nb_coefficient"]) == pytest.approx(tuple(at[:2]), abs=2e-4)
        assert r["theta"] == pytest.approx(math.exp(at[2]), rel=1e-3)
        mu = e * np.exp(r["nb_intercept"] + r["nb_coefficient"] * x)
        w = mu * r["theta"] / (mu + r["theta"])
        info = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]])
        assert r["nb_std_error"] == pytest.approx(math.sqrt(np.linalg.inv(info)[1, 1]), rel=1e-6)


def test_family_follows_the_dispersion(frame):
    out = {r["product_line_id"]: r for r in market_model(frame, overdispersed=1.6).collect()}
    assert {k: r["family_used"] for k, r in out.items()} == {"A": "negative_binomial", "B": "negative_binomial", "C": "quasipoisson"}
    assert out["C"]["theta"] is None and out["A"]["theta"] > 0
    assert out["A"]["conf_low"] < out["A"]["coefficient"] < out["A"]["conf_high"] and out["A"]["n_own"] + out["A"]["n_competitor"] == 400
    plain = {r["product_line_id"]: r["coefficient"] for r in fit(compress(frame), quasi=True).collect()}
    assert out["C"]["coefficient"] == plain["C"] and out["A"]["coefficient"] != plain["A"]


def test_counts_without_scatter_keep_their_family(frame):
    # no finite theta: the fallback gives up and the quasi-Poisson numbers stay
    out = market_model(frame.filter("product_line_id = 'C'").withColumn("y", 5 + F.col("x") % 2).withColumn("exposure", F.lit(1.0)), overdispersed=0.0).first()
    assert out["family_used"] == "quasipoisson"


def test_gamma_functions(spark):
    row = spark.range(1).select(*[f(F.lit(v)).alias(f"{n}{i}") for n, f in (("l", log_gamma), ("d", digamma), ("t", trigamma)) for i, v in enumerate((0.05, 1.0, 7.5))]).first()
    for i, v in enumerate((0.05, 1.0, 7.5)):
        assert row[f"l{i}"] == pytest.approx(math.lgamma(v), abs=1e-10)
        h = 1e-5 * v
        assert row[f"d{i}"] == pytest.approx((math.lgamma(v + h) - math.lgamma(v - h)) / (2 * h), rel=1e-6)
    assert row["t1"] == pytest.approx(math.pi**2 / 6, rel=1e-10)


def test_sql_of_tail_and_gamma_derivatives():
    con = duckdb.connect()
    one = lambda sql, v: con.execute(f"SELECT {sql} FROM (SELECT CAST(? AS DOUBLE) AS v)", [v]).fetchone()[0]
    for z in (0.0, 1e-6, 0.3, -1.96, 4.0, 8.9, 30.0):
        assert one(normal_tail_sql("v"), z) == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)
    for v in (0.2, 1.0, 7.5, 900.0):
        # differences of neighbours: psi(v + 1) - psi(v) = 1 / v, and the slope of psi
        assert one(digamma_sql("(v + 1)") + " - " + digamma_sql("v"), v) == pytest.approx(1 / v, abs=1e-9)
        slope = (math.lgamma(v + 1e-4) - math.lgamma(v - 1e-4)) / 2e-4
        assert one(digamma_sql("v"), v) == pytest.approx(slope, abs=1e-5)
        assert one(trigamma_sql("v") + " - " + trigamma_sql("(v + 1)"), v) == pytest.approx(1 / v**2, abs=1e-8)
