"""Aliased predictors: pairs, combinations, lines apart, gaps; missing columns."""

from __future__ import annotations

import numpy as np

from martloom.operators.aliasing import aliased, eliminated, with_structure
from martloom.operators.poisson import compress, estimability, to_long

SCHEMA = "product_line_id string, sales double, a double, b double, c double, d double, e double"


def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for line in "XY":
        for i in range(60):
            a, b = float(rng.integers(0, 9)), float(rng.normal())
            c = 3 * a - 2 * b + 1 if line == "X" else float(rng.normal())
            rows.append((line, float(rng.poisson(3)), a, b, c, -a / 7 if i % 5 else None, 1e6 + 1e-2 * a * a))
    return spark.createDataFrame(rows + [("Z", 1.0, 1.0, None, 2.0, 2.0, 5.0)], SCHEMA)


def test_combinations_are_found_by_line(spark):
    found = {(r.product_line_id, r.predictor) for r in aliased(frame(spark), ["a", "b", "c", "d", "e"]).collect()}
    assert found == {("X", "c"), ("X", "d"), ("Y", "d")}
    # the order decides who repeats whom
    assert {(r.product_line_id, r.predictor) for r in aliased(frame(spark), ["d", "c", "b", "a"]).collect()} == {("X", "b"), ("X", "a"), ("Y", "a")}


def test_status_of_aliased_and_missing(spark):
    df = frame(spark)
    gate = estimability(compress(to_long(df, ["a", "b", "c", "d", "e"])))
    found = {(r.product_line_id, r.predictor): (r.estimation_status, r.drop_reason) for r in with_structure(gate, df, ["a", "b", "c", "d", "e", "weight"]).collect()}
    assert len(found) == 18
    assert found["X", "c"] == ("not_estimable", "aliased") and found["Y", "c"] == ("estimated", None)
    assert all(found[line, "weight"] == ("not_estimable", "missing_column") for line in "XYZ")
    assert found["Z", "b"] == ("dropped", "all_na_prefilter")


def test_elimination():
    x = np.random.default_rng(1).normal(size=(50, 3))
    x = np.column_stack([x, x[:, 0] + x[:, 2], np.zeros(50), x[:, 1] * 1e-8])
    assert eliminated(x.T @ x) == [3, 5]


def test_no_rows(spark):
    assert aliased(frame(spark).limit(0), ["a", "b"]).count() == 0
