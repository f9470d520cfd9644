"""Recommendations: no leak, every product reachable, one row per customer; labels of market attributes."""

from __future__ import annotations

from datetime import datetime

import pytest

from martloom.operators import market, recommend, reviews


@pytest.fixture(scope="module")
def sales(spark):
    rows = []
    for c in range(40):
        for step in range(6):
            rows.append((c, datetime(2024, 1, 1 + step), c * 10 + step, 1, (c + step) % 4 * 10, 5.0 + step))
    rows += [(100, datetime(2024, 2, 1), 9001, 1, 770, 1.0), (100, datetime(2024, 2, 2), 9002, 1, 880, 1.0)]  # a pair sold once
    rows += [(101, datetime(2024, 2, 1), 9003, 1, 770, 1.0), (102, datetime(2024, 2, 1), 9004, 1, 990, None)]
    return spark.createDataFrame(rows, "customer_id long, payment_time timestamp, order_id long, line_number int, product_id long, paid double")


def test_states_hold_only_what_was_known(sales):
    rows = recommend.purchase_states(sales, "paid").filter("customer_id = 3").orderBy("purchases").collect()
    assert [r.purchases for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.spent for r in rows] == [5.0, 11.0, 18.0, 26.0, 35.0, 45.0]
    assert [r.span_days for r in rows] == [0, 1, 2, 3, 4, 5]
    assert all(r.next_product != r.last_product for r in rows) and rows[-1].next_product is None


def test_label_is_not_a_feature(sales):
    states, trans = recommend.purchase_states(sales, "paid"), recommend.transitions(sales)
    past = states.filter("next_product is not null")
    known = recommend.candidates(past, trans, True)
    # the only step from 770 is the judged one, so nothing else speaks for it
    only = known.filter("customer_id = 100").collect()
    assert [(r.item, r.label, r.chance) for r in only] == [(880, 1.0, 0.0)]


def test_every_customer_gets_a_row_and_rare_products_stay_reachable(sales):
    found = {r.customer_id: r for r in recommend.product_recommendations(recommend.purchase_states(sales, "paid"), recommend.transitions(sales)).collect()}
    assert len(found) == 43
    assert found[101].product_1 == 880
    assert found[100].product_1 is None and found[102].product_1 is None
    for c in range(40):
        last = (c + 5) % 4 * 10
        assert found[c].product_1 == (last + 10) % 40
        chain = [found[c][f"product_{i}"] for i in range(1, 6)]
        known = [p for p in chain if p is not None]
        assert known == list(dict.fromkeys(known))


def test_cells_give_the_picks_of_every_pair(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    rows = [(c, datetime(2024, 1, 1 + s * (1 + c % 3)), c * 10 + s, 1, (c * c + s * (3 + c % 5)) % 7, float(1 + (c * 7 + s) % 11)) for c in range(300) for s in range(2 + c % 5)]
    sales = spark.createDataFrame(rows, "customer_id long, payment_time timestamp, order_id long, line_number int, product_id long, paid double")
    states, trans = recommend.purchase_states(sales, "paid").cache(), recommend.transitions(sales).cache()
    final, past = states.filter("next_product is null"), states.filter("next_product <> last_product")
    model, cuts = recommend.fit_forest(recommend.candidates(past, trans, True), 20, 500)
    assert all(cuts[f] for f in ("purchases", "mean_spent", "chance"))
    pairs = recommend.candidates(final, trans, False)
    scored = model.transform(VectorAssembler(inputCols=recommend.FEATURES, outputCol="features").transform(pairs)).withColumn("_w", vector_to_array("_votes")[1])
    want = scored.groupBy("customer_id").agg(F.max_by("item", F.struct("_w", "chance", -F.col("item"))).alias("p"))
    chosen = recommend.cell_choices(final, trans, model, cuts)
    got = recommend.with_cells(final, cuts).join(chosen, ["last_product", *recommend.CELL])
    assert {r.customer_id: r.recommended_product for r in got.collect()} == {r.customer_id: r.p for r in want.collect()}
    assert chosen.count() < final.count() / 2  # customers share cells


def test_learning_rows_are_bounded(spark):
    past = spark.range(10000).selectExpr("id customer_id", "1 last_product")
    trans = spark.range(100).selectExpr("1 from_product", "id to_product", "1 n")
    assert recommend.learning_states(past, trans, 1_000_000, 5).count() == 10000
    assert 800 < recommend.learning_states(past, trans, 100_000, 5).count() < 1200
    assert recommend.learning_states(past, trans.limit(0), 10, 5).count() == 10000


def test_no_sales(sales):
    empty = sales.limit(0)
    assert recommend.product_recommendations(recommend.purchase_states(empty, "paid"), recommend.transitions(empty)).count() == 0


def test_kinds_of_market_attributes(spark):
    names = [("L", "comfort"), ("L", "easy"), ("L", "brand::a")]
    results = spark.createDataFrame([(*n, 0.1, 1.0) for n in names], "product_line_id string, predictor string, coefficient double, predictor_range double")
    scales = spark.createDataFrame([("L", "comfort", "5尺度"), ("L", "easy", "2尺度")], "product_line_id string, predictor string, scale string")
    got = {r.predictor: (r.attr_kind, r.predictor_type) for r in market.label_attributes(results, scales).collect()}
    assert got == {
        "comfort": ("rating", "product_attribute"),
        "easy": ("mention_proportion", "comment_attribute"),
        "brand::a": ("product_feature", "product_attribute"),
    }


def test_only_competitors_are_rated_per_product(spark):
    rows = [(i, f"2024-01-{1 + i % 28:02d}", "L", p, p != "own") for i, p in enumerate(["own", "x", "y"] * 20)]
    reviewed = spark.createDataFrame(rows, "review_id int, review_date string, product_line_id string, product_id string, included_competitor boolean")
    topics = spark.createDataFrame([("L", "t")], "product_line_id string, topic string")
    defs = spark.createDataFrame([("L", "t", "what")], "product_line_id string, topic string, definition string")
    got = reviews.rating_frame(reviewed, topics, defs, 3).groupBy("product_id").count().collect()
    assert {r["product_id"]: r["count"] for r in got} == {"x": 3, "y": 3}


def test_purchases_are_put_in_order_once(sales):
    from martloom import session

    written = lambda: sum("/ordered-" in p for paths in session._STAGES.values() for p in paths)
    before = written()
    recommend.purchase_states(sales, "paid")
    assert written() == before + 1
    states, trans = recommend.states_and_transitions(sales, "paid")
    assert written() == before + 2
    assert sorted(states.collect()) == sorted(recommend.purchase_states(sales, "paid").collect())
    assert sorted(trans.collect()) == sorted(recommend.transitions(sales).collect())
