from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.operators import clean


def one(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_mixed_dates(spark):
    cases = {
        "45292": datetime(2024, 1, 1),
        "45292.5": datetime(2024, 1, 1, 12),
        "2024-01-02": datetime(2024, 1, 2),
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.25": datetime(2024, 1, 2, 3, 4, 5, 250000),
        "2024/1/2": datetime(2024, 1, 2),
        "02/03/2024": datetime(2024, 2, 3),
        "31/03/2024": datetime(2024, 3, 31),
        "1/5/2024 7:08:09": datetime(2024, 1, 5, 7, 8, 9),
        "2024-02-31": None,
        "19999": None,
        "80001": None,
        " ": None,
        "garbage": None,
        None: None,
    }
    df = one(spark, list(cases)).select("c", dates.parse_mixed_ts(F.col("c")).cast("timestamp_ntz").alias("t"))
    assert {r["c"]: r["t"] for r in df.collect()} == cases


def test_other_dates(spark):
    df = one(spark, ["2024-05", "2024-05-09", "x"]).select(dates.month_to_date(F.col("c")).alias("d"))
    assert [r[0] for r in df.collect()] == [date(2024, 5, 1), date(2024, 5, 9), None]
    df = one(spark, ["202405091230", "20241301", "2024"]).select(dates.parse_compact(F.col("c")))
    assert [r[0] for r in df.collect()] == [date(2024, 5, 9), None, None]
    said = ["Reviewed in Japan on March 5, 2023", "2023-03-05", "Reviewed soon"]
    df = one(spark, said).select(dates.review_date(F.col("c")))
    assert [r[0] for r in df.collect()] == [date(2023, 3, 5), date(2023, 3, 5), None]


def test_blank_rules(spark):
    df = one(spark, ["a", " ", "", "NA", " NA ", None])
    assert [r[0] for r in clean.blank_to_null(df).collect()] == ["a", None, None, None, None, None]
    assert clean.require_nonblank(df, ["c"]).count() == 3
    assert [r[0] for r in clean.drop_sentinels(one(spark, ["x", "UNKNOWN", "unclassified", " ", None]), "c").collect()] == ["x"]


def test_null_if_keeps_rows(spark):
    df = spark.createDataFrame([(0, "a@b.co"), (-1, "bad"), (5, None)], "q int, mail string")
    out = clean.null_if(df, {"q": F.col("q") <= 0, "mail": ~text.valid_email(F.col("mail"))})
    assert [tuple(r) for r in out.collect()] == [(None, "a@b.co"), (None, None), (5, None)]


def test_money_and_margin(spark):
    df = spark.createDataFrame([(2.0, None, 9.99), (3.0, 4.0, None), (1.0, 5.0, 6.0)], "quantity double, unit_price double, discounted_price double")
    out = clean.derive_money(df).select("unit_price", "line_total", "discount").collect()
    # 9.99 / 2 = 4.995 is rounded half up
    assert [tuple(r) for r in out] == [(5.0, 9.99, 0.0), (4.0, 12.0, 0.0), (5.0, 6.0, 0.0)]
    m = spark.createDataFrame([(1.0, 0.0, 3.0, None)], "quantity double, transaction_price double, unit_price double, shipping_fee double")
    assert clean.derive_margin(m).first()["profit_margin"] == 0.0


def test_backfill_reports_what_it_touches(spark):
    df = spark.createDataFrame(
        [("UNKNOWN_PRODUCT", "B000000001", 1), ("", "sku-1", 2), (None, "B000000002", 3), ("P1", "B000000003", 4)], "item string, sku string, row long"
    )
    fixed, audit = clean.backfill_id(df, "item", "sku", "t", "row")
    assert [r["item"] for r in fixed.orderBy("row").collect()] == ["B000000001", "", "B000000002", "P1"]
    assert sorted(r["source_row_id"] for r in audit.collect()) == ["1", "3"]


def test_first_present_and_lineage(spark):
    df = spark.createDataFrame([(1, 2)], "b int, c int")
    assert clean.first_present(df, "out", ["a", "b", "c"]).first()["out"] == 1
    with pytest.raises(ValueError):
        clean.first_present(df, "out", ["x"])
    assert "platform_id" in clean.with_lineage(df, "amz", "v", "p").columns


def test_identity_ladder(spark):
    df = spark.createDataFrame(
        [(" Z1 ", "City", "ST", "US", "b1", 1), (None, "City", "ST", "US", "b1", 2), (" ", None, "ST", "US", " B2", 3), (None, " ", None, "US", None, 4)],
        "ship_postal_code string, ship_city string, ship_state string, ship_country string, buyer_identification_number string, order_id int",
    )
    got = [r[0] for r in df.select(text.identity_key(df)).collect()]
    assert got == ["postal::z1::city::st::us", "geo::city::st::us", "bid::b2", "order::4"]
    lite = df.drop("ship_city", "ship_postal_code")
    assert lite.select(text.identity_key(lite)).first()[0] == "state::st::us"


def test_names_scales_codes(spark):
    df = one(spark, ["安心/保護到位", "  A b--C "])
    assert [r[0] for r in df.select(text.canon_name(F.col("c"))).collect()] == ["安心_保護到位", "a_b_c"]
    df = one(spark, ["2", " 5尺度", None, "", "3"])
    assert [r[0] for r in df.select(text.norm_scale(F.col("c"))).collect()] == ["2尺度", "5尺度", "5尺度", "5尺度", "3"]
    df = one(spark, ["已出貨", " Odd ", None])
    assert [r[0] for r in df.select(text.order_status(F.col("c"))).collect()] == ["shipped", "odd", None]
    assert [r[0] for r in one(spark, ["PayPal", "x", None]).select(text.payment_method(F.col("c"))).collect()] == ["paypal", "other", "other"]


def test_text_repair(spark):
    df = one(spark, ["ok\x00\x07", "\x01", "caf�", "fine"])
    assert [r[0] for r in text.clean_text(df).collect()] == ["ok", None, "caf�", "fine"]
    audit = text.mojibake_audit(df).first()
    assert audit["n_suspect"] == 3


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    rows = [("a", i, str(i)) for i in range(50)] + [("b", 1, None)]
    one_way = spark.createDataFrame(rows, "cell string, x int, y string")
    other = spark.createDataFrame(rows[::-1], "cell string, x int, y string").repartition(5)
    changed = spark.createDataFrame([("a", 49, "0"), *rows[1:]], "cell string, x int, y string")
    prints = [dict(text.fingerprint(d, ["cell"], ["x", "y"]).collect()) for d in (one_way, other, changed)]
    assert prints[0] == prints[1]
    assert prints[0]["a"] != prints[2]["a"] and prints[0]["b"] == prints[2]["b"]
