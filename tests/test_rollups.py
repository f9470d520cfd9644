"""Roll-ups by place and period against plain counting, nulls included, and their plans."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martloom.operators import geo, macro

SCHEMA = "platform_id string, country string, product_line_id string, order_id long, customer_id long, order_date date, order_status string, lineproduct_price double"


@pytest.fixture(scope="module")
def rows():
    lines = ["A", "B", None, "C"]
    out = []
    for i in range(400):
        country = None if i % 11 == 0 else "TW" if i % 3 else "DE"
        day = date(2024, 1, 1) + timedelta(days=i * 5 % 300)
        order, customer = None if i % 37 == 0 else i // 3, None if i % 41 == 0 else i * i % 57
        out.append(("amz" if i % 2 else "cbz", country, lines[i % 4], order, customer, day, "shipped" if i % 5 else "canceled", None if i % 19 == 0 else i / 4))
    return out


def counted(rows, key, measures):
    """Every measure per key and line, and under `all`, from plain sets."""
    groups: dict = {}
    for r in rows:
        for line in (r[2], "all"):
            groups.setdefault((*key(r), line), []).append(r)
    return {k: measures(g) for k, g in groups.items()}


def distinct(g, i):
    return len({r[i] for r in g} - {None})


def money(g):
    paid = [r[7] for r in g if r[7] is not None]
    return sum(paid) if paid else None


@pytest.mark.parametrize("together", [False, True])
def test_places(spark, rows, together):
    got = geo.geo_sales(spark.createDataFrame(rows, SCHEMA), "country", together).collect()
    want = counted([r for r in rows if r[6] == "shipped"], lambda r: ("all" if together else r[0], r[1]), lambda g: (distinct(g, 3), distinct(g, 4), money(g)))
    assert {(r.platform_id, r.country, r.product_line_id): (r.orders, r.customers, r.revenue) for r in got} == want
    assert len(got) == len(want)


def test_months_and_new_customers(spark, rows):
    got = macro.macro_monthly(spark.createDataFrame(rows, SCHEMA)).collect()
    month = lambda r: r[5].replace(day=1)
    want = counted(rows, lambda r: (r[0], month(r)), lambda g: (distinct(g, 3), distinct(g, 4), money(g)))
    assert {(r.platform_id, r.period, r.product_line_id): (r.orders, r.active_customers, r.revenue) for r in got} == want
    first: dict = {}
    for r in rows:
        for line in (r[2], "all"):
            key = (r[0], line, r[4])
            first[key] = min(first.get(key, month(r)), month(r))
    for r in got:
        assert r.new_customers == sum(p == r.period for (platform, line, _), p in first.items() if (platform, line) == (r.platform_id, r.product_line_id))


def test_no_source_row_is_repeated(spark, rows):
    sales = spark.createDataFrame(rows, SCHEMA)
    for df in (geo.geo_country(sales), macro.macro_monthly(sales)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan  # reads the presence table only


def test_no_sales(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert geo.geo_country(empty).count() == 0 and macro.macro_monthly(empty).filter(F.lit(True)).count() == 0
