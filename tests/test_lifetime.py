"""BG/NBD fit: simulated customers, derivatives, likelihood of a plain evaluation, scopes without a fit."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import customer as cus
from martloom.operators.lifetime import PARAMETERS, compressed, fit_lifetime, terms

TRUE = {"r": 0.8, "alpha": 6.0, "a": 0.9, "b": 2.5}


def simulated(n, seed, r, alpha, a, b):
    """(f_value, r_value, customer_tenure_days) of customers who live by the model; days are whole."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        rate, quits, age = rng.gamma(r) / alpha, rng.beta(a, b), rng.uniform(60, 150)
        x, now, last = 0, 0.0, 0.0
        while True:
            now += rng.exponential(1 / rate)
            if now > age:
                break
            x, last = x + 1, now
            if rng.random() < quits:
                break
        rows.append((x + 1, int(round((age - last) * 7)), int(round(age * 7))))
    return rows


@pytest.fixture(scope="module")
def shops(spark):
    rows = [("big", "all", i, *r) for i, r in enumerate(simulated(20000, 1, **TRUE))]
    other = {"r": 2.0, "alpha": 9.0, "a": 0.4, "b": 3.0}
    rows += [("big", "B", i, *r) for i, r in enumerate(simulated(8000, 2, **other))]
    rows += [("small", "A", 1, 1, 5, 5), ("small", "A", 2, 3, 0, 9), ("small", "A", 3, None, 0, 9)]
    return spark.createDataFrame(rows, "platform_id string, product_line_id_filter string, customer_id int, f_value long, r_value int, customer_tenure_days int").cache()


def test_parameters_of_simulated_customers_are_found(shops):
    fits = {r["product_line_id_filter"]: r.asDict() for r in fit_lifetime(shops, cus.SCOPE).collect()}
    assert {k: f["fit_status"] for k, f in fits.items()} == {"all": "fitted", "B": "fitted", "A": "insufficient_rows"}
    # a and b trade against each other; their ratio, the chance to leave, is what the data tell
    for key in ("r", "alpha"):
        assert fits["all"][key] == pytest.approx(TRUE[key], rel=0.05)
    assert fits["all"]["a"] / (fits["all"]["a"] + fits["all"]["b"]) == pytest.approx(0.9 / 3.4, rel=0.05)
    assert fits["B"]["r"] == pytest.approx(2.0, rel=0.05) and fits["B"]["alpha"] == pytest.approx(9.0, rel=0.05)
    assert fits["A"]["r"] is None and fits["A"]["customers"] == 2


def plain_likelihood(rows, r, alpha, a, b):
    total = 0.0
    for x, t_x, age, n in rows:
        value = math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b) + math.lgamma(b + x) - math.lgamma(b) - math.lgamma(a + b + x)
        odds = a / (b + x - 1) * ((alpha + age) / (alpha + t_x)) ** (r + x) if x else 0.0
        total += n * (value - (r + x) * math.log(alpha + age) + math.log1p(odds))
    return total


def test_fit_is_a_maximum_of_the_plain_likelihood(shops):
    counts = [(r.x, r.t_x / 7, r.age / 7, r.n) for r in compressed(shops.filter("product_line_id_filter = 'B'"), cus.SCOPE).collect()]
    fit = fit_lifetime(shops.filter("product_line_id_filter = 'B'"), cus.SCOPE).first()
    best = [fit[p] for p in PARAMETERS]
    top = plain_likelihood(counts, *best)
    assert fit["log_likelihood"] == pytest.approx(top, rel=1e-9)
    for i in range(4):
        for factor in (0.97, 1.03):
            moved = list(best)
            moved[i] *= factor
            assert plain_likelihood(counts, *moved) < top


def test_derivatives_match_differences():
    x, t_x, age = np.array([0.0, 1.0, 4.0, 30.0]), np.array([0.0, 3.0, 20.0, 90.0]), np.array([50.0, 60.0, 21.0, 95.0])
    at = np.array([0.7, 5.0, 0.8, 2.2])
    here = terms(x, t_x, age, *at)
    for i in range(4):
        h = 1e-5 * at[i]
        up, down = (terms(x, t_x, age, *(at + s * h * np.eye(4)[i])) for s in (1, -1))
        assert np.allclose((up[:, 0] - down[:, 0]) / (2 * h), here[:, 1 + i], rtol=1e-5, atol=1e-6)
        assert np.allclose((up[:, 1:5] - down[:, 1:5]) / (2 * h), here[:, 5 + 4 * i : 9 + 4 * i], rtol=1e-5, atol=1e-6)


def test_fitted_scores_use_the_scope_of_the_customer(shops):
    scored = cus.fitted_clv(shops.withColumn("m_value", F.lit(10.0)).filter("f_value is not null"))
    rows = scored.groupBy("product_line_id_filter").agg(F.min("p_alive").alias("lo"), F.max("p_alive").alias("hi"), F.count("clv").alias("n"), F.max("fit_status").alias("s")).collect()
    by = {r["product_line_id_filter"]: r for r in rows}
    assert by["A"]["n"] == 0 and by["A"]["s"] == "insufficient_rows"
    assert 0 <= by["all"]["lo"] < by["all"]["hi"] <= 1 and by["all"]["n"] == 20000


def test_no_customers(spark):
    empty = spark.createDataFrame([], "platform_id string, product_line_id_filter string, f_value long, r_value int, customer_tenure_days int")
    assert fit_lifetime(empty, cus.SCOPE).count() == 0
