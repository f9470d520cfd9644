from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom import session
from martloom.operators import customer as cus


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (1, datetime(2024, 1, 1, 9), 10.0, "amz", "A", 1),
        (1, datetime(2024, 1, 1, 12), 5.0, "amz", "B", 2),
        (1, datetime(2024, 1, 11), 7.0, "amz", "A", 3),
        (1, datetime(2024, 1, 16), 8.0, "amz", "A", 4),
        (2, datetime(2024, 1, 5), 3.0, "amz", "A", 5),
        (3, datetime(2023, 2, 1), 3.0, "amz", "B", 6),
        (3, datetime(2023, 2, 5), 4.0, "amz", "B", 7),
        (1, datetime(2024, 1, 2), 1.0, "eby", "A", 8),
    ]
    return spark.createDataFrame(rows, "customer_id int, payment_time timestamp, lineproduct_price double, platform_id string, product_line_id string, order_id int")


def pick(df, **keys):
    for k, v in keys.items():
        df = df.filter(F.col(k) == v)
    return df.collect()


def test_same_day_purchases_are_one_purchase_day(sales):
    days = cus.customer_by_date(sales)
    first = pick(days, customer_id=1, platform_id="amz", product_line_id_filter="all", date=date(2024, 1, 1))[0]
    assert (first["sum_spent_by_date"], first["count_transactions_by_date"], first["min_time_by_date"]) == (15.0, 2, datetime(2024, 1, 1, 9))
    total = pick(cus.by_customer(days), customer_id=1, platform_id="amz", product_line_id_filter="all")[0]
    assert (total["ni"], total["ipt"], total["sum_transactions_by_customer"]) == (3, 7.5, 4)


def test_single_purchase_has_no_interval(sales):
    total = pick(cus.by_customer(cus.customer_by_date(sales)), customer_id=2, product_line_id_filter="all")[0]
    assert total["ni"] == 1 and total["ipt"] is None
    index = pick(cus.cai(cus.customer_by_date(sales)), customer_id=2, product_line_id_filter="all")[0]
    assert index["cai"] is None and index["gap_variation"] is None


def test_activity_index_sign(sales):
    # gaps 10 then 5: getting faster, so positive
    index = pick(cus.cai(cus.customer_by_date(sales)), customer_id=1, platform_id="amz", product_line_id_filter="all")[0]
    assert index["cai"] == pytest.approx((7.5 - 20 / 3) / 7.5)
    assert index["gap_variation"] == pytest.approx(np.std([10, 5], ddof=1) / 7.5)


def test_status_ladder(spark):
    rows = [(i, "p", "all", r, f, 10.0) for i, (r, f) in enumerate([(5, 1), (20, 3), (24, 3), (30, 3), (31, 3), (25, 1)])]
    df = spark.createDataFrame(rows, "customer_id int, platform_id string, product_line_id_filter string, r_value int, f_value int, ipt double")
    got = [r["nes_status"] for r in cus.nes_status(df).orderBy("customer_id").collect()]
    assert got == ["N", "E0", "S1", "S2", "S3", "S1"]
    alone = df.withColumn("ipt", F.lit(None).cast("double")).filter("f_value = 1")
    assert {r["nes_status"] for r in cus.nes_status(alone).collect()} == {"N"}


def test_expected_purchases_against_direct_series(spark):
    rows = [("p", "all", 1, 0, 1, 20.0, 0), ("p", "all", 2, 30, 5, 20.0, 400), ("p", "all", 3, 200, 30, 10.0, 2000)]
    df = spark.createDataFrame(rows, "platform_id string, product_line_id_filter string, customer_id int, r_value int, f_value int, m_value double, customer_tenure_days int")
    p = cus.BGNBD
    for row in cus.p_alive_clv(df).collect():
        x, age, tx = row["f_value"] - 1, row["customer_tenure_days"] / 7, (row["customer_tenure_days"] - row["r_value"]) / 7
        a_, b_, c_ = p["r"] + x, p["b"] + x, p["a"] + p["b"] + x - 1
        z = 52 / (p["alpha"] + age + 52)
        term = total = 1.0
        for j in range(20000):
            term *= (a_ + j) * (b_ + j) / (c_ + j) / (j + 1) * z
            total += term
        drop = p["a"] / (p["b"] + x - 1) * ((p["alpha"] + age) / (p["alpha"] + tx)) ** (p["r"] + x) if x else 0.0
        want = c_ / (p["a"] - 1) * (1 - ((p["alpha"] + age) / (p["alpha"] + age + 52)) ** a_ * total) / (1 + drop)
        assert row["expected_purchases"] == pytest.approx(want, rel=1e-8)
        assert row["p_alive"] == pytest.approx(1 / (1 + drop))
        assert row["clv"] == pytest.approx(want * row["m_value"], rel=1e-8)


def test_dna_has_one_row_per_customer_and_scope(sales):
    days = cus.customer_by_date(sales)
    dna = cus.customer_dna(days, F.lit(date(2024, 1, 20)))
    assert dna.count() == cus.by_customer(days).count() == dna.select(*cus.CUSTOMER).distinct().count()
    assert set(cus.SALES_COLUMNS) <= set(sales.columns)
    assert dna.filter("dna_segment is null or dna_r_score is null").count() == 0


def test_snapshots_skip_periods_without_rows(sales):
    days = cus.customer_by_date(sales).filter("platform_id = 'eby'")
    snaps = cus.dna_snapshots(days, F.lit(date(2024, 1, 20)))
    assert {r["period"] for r in snaps.collect()} == {"now"}
    assert cus.nes_transitions(snaps).count() == 0


def test_cross_category_ignores_sentinels(spark):
    rows = [("p", 1, "A"), ("p", 1, "all"), ("p", 1, "unclassified"), ("p", 2, "A"), ("p", 2, "B"), ("p", 3, None)]
    df = spark.createDataFrame(rows, "platform_id string, customer_id int, product_line_id_filter string")
    got = cus.cross_category(df).first()
    assert (got["customers"], got["one_line"], got["two_lines"], got["cross_rate"]) == (2, 1, 1, 0.5)


def test_empty_sales(sales):
    days = cus.customer_by_date(sales.limit(0))
    assert cus.customer_dna(days, F.lit(date(2024, 1, 1))).count() == 0
    assert cus.check_sales(sales.limit(0), ["amz"]).filter("status = 'FAIL'").count() == 2


def test_profile_takes_the_latest_name(spark):
    rows = [(1, "amz", datetime(2024, 1, 1), 1, "Old", "o@x"), (1, "amz", datetime(2024, 2, 1), 2, "New", "n@x")]
    df = spark.createDataFrame(rows, "customer_id int, platform_id string, payment_time timestamp, order_id int, buyer_name string, email string")
    assert cus.customer_profile(df).first()["buyer_name"] == "New"


def test_snapshots_repeat_no_purchase_day(spark, monkeypatch):
    days = spark.createDataFrame(
        [("amz", "all", 1, date(2023, 1, 10), 10.0), ("amz", "all", 1, date(2023, 3, 1), None), ("amz", "all", 1, date(2024, 1, 10), 5.0),
         ("amz", "all", 2, date(2024, 1, 9), 3.0), ("amz", "all", 3, None, 9.0)],
        "platform_id string, product_line_id_filter string, customer_id long, date date, sum_spent_by_date double",
    )
    monkeypatch.setattr(cus, "nes_status", lambda table, scope: table)
    base = cus.dna_snapshots(days, F.lit(date(2024, 1, 10)))
    got = {(r.customer_id, r.period): (r.f_value, r.m_value, r.ipt, r.r_value) for r in base.collect()}
    early = (2, 5.0, 50.0)
    assert got == {
        (1, "now"): (3, 5.0, 182.5, 0), (2, "now"): (1, 3.0, None, 1),
        (1, "month_ago"): (*early, 284), (1, "quarter_ago"): (*early, 223), (1, "year_ago"): (1, 10.0, None, 0),
    }
    plan = base._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # the root is printed first: customers are spread, not days


def test_task_bytes_yield_to_the_session(spark):
    key, value = session.TASK_BYTES
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert session.configure(spark).conf.get(key) == value
        spark.conf.set(key, "8m")
        assert session.configure(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
