"""Poisson fits against closed forms, MLlib and each other."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from martloom.operators import market, poisson


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        x, flag = rng.uniform(-2, 3), float(rng.random() < 0.3)
        y = float(rng.randint(0, 4)) + round(math.exp(0.4 * x) + 2 * flag)
        rows.append(("L", y, x, flag, float(rng.randint(1, 12)), float("nan") if i % 10 == 0 else float(i % 4)))
    return spark.createDataFrame(rows, "product_line_id string, sales double, x double, flag double, months double, gaps double")


def by_predictor(df):
    return {r["predictor"]: r for r in df.collect()}


def test_binary_closed_form(frame):
    got = by_predictor(poisson.poisson_univariate(frame, ["flag"]))["flag"]
    s = {r["flag"]: (r["m"], r["t"]) for r in frame.groupBy("flag").agg(F.avg("sales").alias("m"), F.sum("sales").alias("t")).collect()}
    assert got["coefficient"] == pytest.approx(math.log(s[1.0][0] / s[0.0][0]), rel=1e-12)
    assert got["std_error"] == pytest.approx(math.sqrt(1 / s[1.0][1] + 1 / s[0.0][1]), rel=1e-12)
    assert got["predictor_is_binary"] and got["track_multiplier"] == 100.0


@pytest.mark.parametrize("column", ["x", "flag", "gaps"])
def test_agrees_with_mllib(frame, column):
    got = by_predictor(poisson.poisson_univariate(frame, [column]))[column]
    data = VectorAssembler(inputCols=[column], outputCol="features").transform(frame.filter(~F.isnan(column)))
    model = GeneralizedLinearRegression(family="poisson", link="log", labelCol="sales", tol=1e-12, maxIter=100).fit(data)
    assert got["coefficient"] == pytest.approx(model.coefficients[0], rel=1e-7)
    assert got["intercept"] == pytest.approx(model.intercept, rel=1e-7)
    assert got["std_error"] == pytest.approx(model.summary.coefficientStandardErrors[0], rel=1e-6)
    assert got["deviance"] == pytest.approx(model.summary.deviance, rel=1e-8)
    assert got["aic"] == pytest.approx(model.summary.aic, rel=1e-8)
    assert got["p_value"] == pytest.approx(math.erfc(abs(got["z_value"]) / math.sqrt(2)), rel=1e-9)


def test_a_model_without_finite_maximum_is_named_so(spark):
    rows = [("L", float(3 * (i == 9)), float(i)) for i in range(10)] + [("M", float(i % 4), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "product_line_id string, sales double, x double")
    got = {r["product_line_id"]: r for r in poisson.poisson_univariate(df, ["x"]).collect()}
    assert (got["L"]["estimation_status"], got["L"]["drop_reason"], got["L"]["coefficient"]) == ("not_estimable", "not_converged", None)
    assert got["M"]["estimation_status"] == "estimated" and got["M"]["coefficient"] is not None


def test_two_valued_exposure_rate(frame):
    got = by_predictor(poisson.poisson_univariate(frame, ["flag"], exposure="months", quasi=True))["flag"]
    r = {r["flag"]: r["s"] / r["e"] for r in frame.groupBy("flag").agg(F.sum("sales").alias("s"), F.sum("months").alias("e")).collect()}
    assert got["coefficient"] == pytest.approx(math.log(r[1.0] / r[0.0]), rel=1e-12)
    solved = poisson.compress(poisson.to_long(frame, ["flag"], exposure="months"))
    mean = frame.groupBy("flag").agg(F.sum("sales").alias("s")).collect()
    assert got["dispersion"] > 0 and len(mean) == 2 and solved.count() > 2


def test_gates(spark):
    rows = [("L", float(i), None, 5.0, float(i % 2), 1.0 if i == 0 else 0.0) for i in range(6)]
    df = spark.createDataFrame(rows, "product_line_id string, sales double, empty double, fixed double, odd double, zero_cell double")
    got = by_predictor(poisson.poisson_univariate(df, ["empty", "fixed", "odd", "zero_cell"]))
    assert (got["empty"]["estimation_status"], got["empty"]["drop_reason"]) == ("dropped", "all_na_prefilter")
    assert (got["fixed"]["estimation_status"], got["fixed"]["drop_reason"]) == ("dropped", "constant_prefilter")
    assert got["odd"]["estimation_status"] == "estimated"
    assert (got["zero_cell"]["estimation_status"], got["zero_cell"]["drop_reason"]) == ("not_estimable", "glm_error")
    two = poisson.poisson_univariate(df.limit(2), ["odd"])
    assert two.first()["drop_reason"] == "insufficient_rows"
    lost = df.withColumn("sales", F.when(F.col("odd") == 1, F.col("sales")))
    assert poisson.poisson_univariate(lost, ["odd"]).first()["drop_reason"] == "constant_in_subset"


def test_no_usable_model_at_all(spark):
    df = spark.createDataFrame([("L", 1.0, 2.0)], "product_line_id string, sales double, a double")
    out = poisson.poisson_univariate(df, ["a"]).collect()
    assert len(out) == 1 and out[0]["coefficient"] is None


def test_separated_predictor_is_not_estimable(spark):
    """Counts only at the largest value: the slope runs away and must not be reported."""
    rows = [("L", 0.0 if x < 9 else 5.0, float(x)) for x in range(10)]
    df = spark.createDataFrame(rows, "product_line_id string, sales double, x double")
    got = poisson.poisson_univariate(df, ["x"]).first()
    assert got["estimation_status"] == "not_estimable" and got["coefficient"] is None


def test_p_value_expression(spark):
    z = [0.0, 1e-6, 0.5, -1.959963984540054, 3.0, 8.0, 20.0, -36.0, 60.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(poisson.two_sided_p(F.col("z"))).collect()]
    for v, p in zip(z, got):
        assert p == pytest.approx(math.erfc(abs(v) / math.sqrt(2)), rel=1e-9, abs=1e-300)


def test_select_predictors(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "t", 4.0)], "product_id int, size double, sales double, note string, `size.x` double")
    assert poisson.select_predictors(df) == ["size"]


def test_market_counts_and_sentinels(spark):
    rows = [("L", "flag", float(i % 2), float(2 + i % 3), float(1 + i % 2), i % 3 == 0) for i in range(12)]
    frame = spark.createDataFrame(rows, "product_line_id string, predictor string, x double, y double, exposure double, is_own boolean")
    got = market.market_model(frame).first()
    assert (got["n_own"], got["n_competitor"], got["family_used"]) == (4, 8, "quasipoisson")
    lines = spark.createDataFrame([("L",), ("M",)], "product_line_id string")
    out = market.market_sentinel(lines, market.market_model(frame)).filter("product_line_id = 'M'").first()
    assert (out["predictor"], out["drop_reason"]) == (market.NO_MARKET, "no_position_rows")


def test_reasons_for_lines_without_a_model(spark):
    lines = spark.createDataFrame([(x,) for x in "ABCDE"], "product_line_id string")
    rows = [("A", 1, 2.0), ("A", 2, 3.0), ("B", None, 1.0), ("B", 1, None), ("C", 1, 0.0), ("C", 2, 0.0), ("D", 1, 4.0)]
    series = spark.createDataFrame(rows, "product_line_id string, time int, sales double")
    gate = spark.createDataFrame([("A", "x", "estimated"), ("D", "x", "dropped")], "product_line_id string, predictor string, estimation_status string")
    reasons = poisson.missing_reasons(lines, series, gate)
    assert {r[0]: r[1] for r in reasons.collect()} == {"B": "no_valid_rows", "C": "all_zero", "D": "no_predictors", "E": "no_series"}
    assert {r[1] for r in poisson.missing_reasons(lines, series.drop("time"), gate).collect()} == {"no_date_column"}
    assert {r[1] for r in poisson.missing_reasons(lines, series.drop("sales"), gate).collect()} == {"no_sales_column"}
    results = gate.filter("product_line_id = 'A'").withColumn("drop_reason", F.lit(None).cast("string"))
    shown = {r["product_line_id"]: r["drop_reason"] for r in poisson.sentinels(lines, results, reasons=reasons).collect()}
    assert shown == {"A": None, "B": "no_valid_rows", "C": "all_zero", "D": "no_predictors", "E": "no_series"}


def test_only_modelable_topics_are_predictors(spark):
    ratings = spark.createDataFrame([(1, "L", "fit", 1.0), (1, "L", "soft", 2.0), (1, "M", "fit", 3.0)], "product_id int, product_line_id string, predictor string, x double")
    listed = [("L", "fit", "attribute"), ("L", "soft", "attribute"), ("L", "soft", "scene"), ("M", "fit", "emotion")]
    kept = market.modelable_topics(ratings, spark.createDataFrame(listed, "product_line_id string, topic string, type string"))
    assert [(r["product_line_id"], r["predictor"]) for r in kept.collect()] == [("L", "fit")]
