"""Chained-equation imputation: whole grid, observed values untouched, reproducible, better than means."""

from __future__ import annotations

import numpy as np
import pytest

from martloom.operators import imputation
from martloom.operators.imputation import impute_chained

TOPICS = ["comfort", "fit", "safety"]


@pytest.fixture(scope="module")
def shop(spark):
    """Line A: fit follows comfort, a third of fit is missing; line B: one topic unrated; line C: nothing rated."""
    rng = np.random.default_rng(3)
    truth, rows, items = {}, [], []
    for i in range(300):
        comfort = rng.uniform(1, 5)
        fit = float(np.clip(6 - comfort + rng.normal(0, 0.2), 0, 6))
        truth[i] = fit
        items.append(("A", i))
        rows += [("A", i, "comfort", comfort), ("A", i, "fit", fit if i % 3 else None), ("A", i, "safety", float(rng.integers(0, 2)))]
    for i in range(1000, 1010):
        items.append(("B", i))
        rows += [("B", i, "comfort", 3.0), ("B", i, "unheard", None)]
    items += [("A", 999), ("C", 2000)]
    topics = [(line, t) for line in "ABC" for t in TOPICS] + [("B", "unheard")]
    make = spark.createDataFrame
    return (
        make(rows, "product_line_id string, product_id long, topic string, rating double"),
        make(items, "product_line_id string, product_id long"),
        make(topics, "product_line_id string, topic string"),
        truth,
    )


def collected(df):
    return {(r.product_line_id, r.product_id, r.topic): r for r in df.collect()}


@pytest.fixture(scope="module")
def imputed(shop):
    ratings, items, topics, _ = shop
    return collected(impute_chained(ratings, items, topics, m=3, rounds=4))


def test_whole_grid_and_observed_values(shop, imputed):
    ratings = {(r.product_line_id, r.product_id, r.topic): r.rating for r in shop[0].collect()}
    assert len(imputed) == 301 * 3 + 10 * 4 + 3
    for key, r in imputed.items():
        known = ratings.get(key)
        assert r.imputed == (known is None)
        if known is not None:
            assert r.rating == known and r.spread is None


def test_regression_beats_the_mean(shop, imputed):
    truth = shop[3]
    gaps = [i for i in range(300) if i % 3 == 0]
    mean = np.mean([truth[i] for i in range(300) if i % 3])
    error = np.mean([(imputed["A", i, "fit"].rating - truth[i]) ** 2 for i in gaps])
    assert error < 0.2 * np.mean([(mean - truth[i]) ** 2 for i in gaps])


def test_values_stay_inside_the_observed_range(shop, imputed):
    low, high = min(v for i, v in shop[3].items() if i % 3), max(v for i, v in shop[3].items() if i % 3)
    assert all(low <= r.rating <= high for (line, _, topic), r in imputed.items() if line == "A" and topic == "fit")


def test_unrated_topics(imputed):
    # line C borrows the topic from the other lines; what nobody rated anywhere stays null
    assert imputed["C", 2000, "comfort"].rating is not None
    assert all(imputed["B", i, "unheard"].rating is None for i in range(1000, 1010))


def test_layout_does_not_matter_but_the_seed_does(shop, imputed):
    ratings, items, topics, _ = shop
    again = collected(impute_chained(ratings.repartition(7), items.repartition(5), topics, m=3, rounds=4))
    assert {k: pytest.approx(r.rating, abs=1e-9) for k, r in imputed.items() if r.rating is not None} == {k: r.rating for k, r in again.items() if r.rating is not None}
    other = collected(impute_chained(ratings, items, topics, m=3, rounds=1, seed=1))
    assert any(other[k].rating != r.rating for k, r in imputed.items() if r.imputed and r.rating is not None)


def test_nothing_to_impute(spark, shop):
    ratings, items, topics, _ = shop
    assert impute_chained(ratings.limit(0), items.limit(0), topics.limit(0), 2, 1).count() == 0


def test_chains_of_lines_of_different_width_are_filled_as_one_column():
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"product_line_id": ["b", "a", "b"], "vals": [[1.0], [2.0, 3.0], [4.0]]})
    filled = imputation._Filled(batch, 2)
    lines = list(imputation._lines(batch))
    assert [(line, rows.tolist(), p) for line, rows, p in lines] == [("a", [1], 2), ("b", [0, 2], 1)]
    filled.put(lines[1][1], np.array([[[1.0], [2.0]], [[7.0], [8.0]]]))
    filled.put(lines[0][1], np.arange(3.0, 7.0).reshape(1, 2, 2))
    assert filled.column().to_pylist() == [[1.0, 2.0], [3.0, 4.0, 5.0, 6.0], [7.0, 8.0]]
