from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom.operators import macro, reshape
from martloom.functions import labels


def test_dense_series_fills_before_between_and_after(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 2.0), ("a", date(2024, 1, 4), 3.0), ("b", date(2024, 1, 3), None), ("b", date(2024, 1, 3), 1.0)], "g string, d date, v double")
    got = {(r["g"], r["d"].day): (r["v"], r["data_source"]) for r in reshape.complete_series(df, "d", ["g"], ["v"]).collect()}
    assert len(got) == 8
    assert got["a", 1] == (2.0, "REAL") and got["a", 2] == (0.0, "FILLED") and got["a", 4] == (3.0, "REAL")
    assert got["b", 1] == (0.0, "FILLED") and got["b", 3] == (1.0, "REAL") and got["b", 4] == (0.0, "FILLED")


def test_dense_series_of_nothing(spark):
    df = spark.createDataFrame([], "g string, d date, v double")
    assert reshape.complete_series(df, "d", ["g"], ["v"]).count() == 0


def test_exposure_sources(spark):
    df = spark.createDataFrame(
        [("sold", date(2024, 1, 5), 0.0), ("sold", date(2024, 3, 1), 1.0), ("never", date(2024, 2, 1), 0.0), ("x", date(2024, 5, 2), 1.0), ("x", None, 1.0)],
        "item string, d date, sales double",
    )
    own = {r["item"]: r["months_listed"] for r in reshape.months_listed(df, "item", "d", "first_to_end").collect()}
    assert own == {"sold": 3, "never": None, "x": 1}
    seen = {r["item"]: r["months_listed"] for r in reshape.months_listed(df, "item", "d", "distinct_months").collect()}
    assert seen == {"sold": 2, "never": 1, "x": 1}
    items = spark.createDataFrame([("sold",), ("never",), ("ghost",)], "item string")
    o = reshape.months_listed(df, "item", "d", "first_to_end")
    c = reshape.months_listed(df.filter("item = 'never'"), "item", "d", "distinct_months")
    got = {r["item"]: (r["months_listed"], r["exposure_source"]) for r in reshape.resolve_exposure(items, "item", o, c, spark.sql("select 12 as _full")).collect()}
    assert got == {"sold": (3, "own"), "never": (1, "competitor"), "ghost": (12, "full_period")}


def test_one_hot_skips_constant_and_excluded_columns(spark):
    df = spark.createDataFrame([(i, "same", "ab"[i % 2] if i else " ", f"u{i}", "x") for i in range(6)], "id int, fixed string, kind string, wide string, skip string")
    got = reshape.one_hot(df, ["id"], ["fixed", "kind", "wide", "skip"], exclude=("skip",))
    wide = [f"wide::u{i}" for i in range(6)]
    assert sorted({r["predictor"] for r in got.collect()}) == ["kind::a", "kind::b", *wide]
    assert got.count() == 11
    skipped = reshape.skipped_parents(df.withColumn("none", F.lit(" ")), ["id"], ["fixed", "kind", "skip", "none"], exclude=("skip",))
    assert {r["parent"]: r["reason"] for r in skipped.collect()} == {"fixed": "constant", "skip": "excluded", "none": "all_blank"}


def test_an_attribute_with_sixty_levels_is_kept(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(60)], "id int, wide string")
    assert reshape.one_hot(df, ["id"], ["wide"]).select("predictor").distinct().count() == 60


def test_binarise_and_pivot(spark):
    df = spark.createDataFrame([("i", "s", 3.0), ("i", "s", 0.0), ("i", "t", None)], "item string, topic string, rating double")
    wide = reshape.ratings_wide(reshape.binarise(df, ["s"]), ["item"], ["s", "t"]).first()
    assert (wide["s"], wide["t"]) == (0.5, None)


def test_suffixes_fold(spark):
    df = spark.createDataFrame([(1, None, 2, 3)], "id int, c int, `c.x` int, `d.y` int")
    row = reshape.coalesce_suffix(df).first().asDict()
    assert row == {"id": 1, "c": 2, "d": 3}


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [("p", "all", date(2023, 1, 1), 100.0), ("p", "all", date(2023, 3, 1), 50.0), ("p", "all", date(2023, 4, 1), 0.0), ("p", "all", date(2024, 1, 1), 150.0), ("p", "all", date(2023, 5, 1), 5.0)]
    return spark.createDataFrame(rows, "platform_id string, product_line_id string, period date, revenue double")


def test_growth_needs_a_base(monthly):
    got = {r["period"]: (r["mom_growth"], r["yoy_growth"]) for r in macro.with_growth(monthly).collect()}
    assert len(got) == 13
    assert got[date(2023, 1, 1)] == (None, None)
    assert got[date(2023, 3, 1)][0] is None  # February is missing
    assert got[date(2023, 4, 1)][0] == -1.0
    assert got[date(2023, 5, 1)][0] is None  # April is zero
    assert got[date(2024, 1, 1)][1] == 0.5


def test_partial_month(monthly):
    flag = lambda d: {r["period"] for r in macro.flag_partial(monthly, F.lit(d)).filter("is_partial_month").collect()}
    assert flag(date(2023, 4, 29)) == {date(2023, 4, 1)}
    assert flag(date(2023, 4, 30)) == set()


def test_time_labels(spark):
    df = spark.createDataFrame([("year",), ("month_12",), ("day",), ("sunday",), ("size",)], "predictor string")
    got = {r["predictor"]: r for r in labels.label_coefficients(df, 2024).collect()}
    assert got["month_12"]["quarter_label"] == "2024年Q4" and got["month_12"]["date_end"] == date(2024, 12, 31)
    assert got["year"]["period_days"] == 366 and got["size"]["period_days"] is None
    assert [got[p]["display_order"] for p in ("year", "month_12", "sunday", "day", "size")] == [1000, 3012, 4007, 5000, 9999]
