"""Registered queries against their SQL on the smallest data; `check.py` runs all of them."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, rows_of

DATA = "/root/testdata/sf0.001"
CHOSEN = """customer_activity_flagship customer_dna customer_rsv_types customer_metric_distribution customer_status_transitions
mixed_date_texts buyer_identity_key line_fingerprints product_line_cascade customer_id_registry fanout_line_sales transaction_ids
global_surrogate_ids snapshot_difference rollup_sales dense_line_series resolved_exposure macro_growth sales_by_country calendar_poisson
predictor_estimability staged_reviews rating_history item_positions market_brand_effects recommendation_chains product_mapping
item_poisson market_model topic_coverage_audit
sales_quality_checks platform_slice_replaced drop_folder_reviews""".split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, con, name):
    df = entry_points.queries()[name](spark, DATA)
    cur = con.execute(entry_points.oracle_sql()[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
