from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martloom.operators import aggregate, lookup, sets, window


def test_composite_join_keeps_sellers_apart(spark):
    o = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "order_id int, seller_email string")
    d = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, None, 30)], "order_id int, batch_key string, qty int")
    got = sorted((r["seller_email"], r["qty"]) for r in lookup.join_order_details(o, d).collect())
    assert got == [("a", 10), ("b", 20)]


def test_cascade_never_changes_the_row_count(spark):
    df = spark.createDataFrame([(1, "s1", "i1", None), (2, "s2", "i2", " "), (3, "s3", "i9", "kept "), (4, None, None, None)], "row int, sku string, item_id string, product_line_id string")
    mapping = spark.createDataFrame([("s1", "i1", "L1"), ("s1", "i1", "L0"), (" ", "i2", "L2"), ("s3", "i9", "L3")], "sku string, item_id string, product_line_id string")
    out = lookup.fill_from_mapping(df, mapping).orderBy("row").collect()
    assert [(r["product_line_id"], r["filled_by"]) for r in out] == [("L0", "sku"), ("L2", "item"), ("kept", "present"), (None, None)]


def test_fanout_keeps_unmapped_and_multiplies_mapped(spark):
    s = spark.createDataFrame([("x", "old"), ("y", "old")], "item string, product_line_id string")
    m = spark.createDataFrame([("x", "A"), ("x", "B"), ("x", "B")], "item string, product_line_id string")
    got = sorted((r["item"], str(r["product_line_id"])) for r in lookup.fanout_map(s, m, "item").collect())
    assert got == [("x", "A"), ("x", "B"), ("y", "None")]


def test_strict_left_join(spark):
    l = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError):
        lookup.left_join_strict(l, spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), ["k"])
    assert lookup.left_join_strict(l, spark.createDataFrame([(1, 1)], "k int, v int"), ["k"]).count() == 2


def test_registry_ids_are_stable(spark):
    first_rows = spark.createDataFrame([("amz", "b"), ("amz", "a"), ("amz", None)], "platform_id string, natural_key string")
    empty = spark.createDataFrame([], "platform_id string, natural_key string, customer_id long")
    named, reg = lookup.assign_ids(first_rows, ["platform_id", "natural_key"], empty)
    assert {r["natural_key"]: r["customer_id"] for r in reg.collect()} == {"a": 1, "b": 2}
    assert named.filter("customer_id is null").count() == 1
    more = spark.createDataFrame([("amz", "0"), ("amz", "a")], "platform_id string, natural_key string")
    _, grown = lookup.assign_ids(more, ["platform_id", "natural_key"], reg)
    assert {r["natural_key"]: r["customer_id"] for r in grown.collect()} == {"a": 1, "b": 2, "0": 3}


def test_collision_policy(spark):
    l = spark.createDataFrame([(1, "left")], "k int, v string")
    r = spark.createDataFrame([(1, "right")], "k int, v string")
    assert lookup.join_suffix(l, r, ["k"]).columns == ["k", "v_profile", "v"]
    with pytest.raises(ValueError):
        lookup.join_suffix(l.withColumnRenamed("v", "v.x"), r, ["k"])


def test_diagnostics_counts_nulls_and_duplicates(spark):
    b = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    p = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    d = lookup.join_diagnostics(b, p, ["k"]).first()
    assert (d["duplicate_build_keys"], d["null_key_rows"], d["shared_keys"], d["coverage_pct"], d["status"]) == (1, 2, 1, 25.0, "WARN")


def test_resolution_reports_only_nonblank_failures(spark):
    dim = spark.createDataFrame([("L1", "Lamps", "燈")], "product_line_id string, name_en string, name_local string")
    df = spark.createDataFrame([("lamps ",), ("燈",), ("L1",), ("nope",), (" ",)], "label string")
    ok, bad = lookup.resolve_line(df, dim, "label")
    assert sorted(str(r["product_line_id"]) for r in ok.collect()) == ["L1", "L1", "L1", "None", "None"]
    assert [r[0] for r in bad.collect()] == ["nope"]


def test_latest_per_key_rejects_null_key_parts(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), (None, 3, "2024-01-03"), (None, 4, "2024-01-04")], "k string, v int, d string")
    assert [r["v"] for r in window.latest_per_key(df, ["k"], "d", ["v"]).collect()] == [2]


def test_tail_breaks_date_ties(spark):
    df = spark.createDataFrame([("a", i, "2024-01-01") for i in range(5)] + [("b", 9, None)], "k string, v int, d string")
    got = sorted(r["v"] for r in window.tail_per_group(df, ["k"], "d", ["v"], 2).collect())
    assert got == [0, 1, 9]


def test_top_k_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = window.first_n_per_key(df, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_exact_duplicates_only(spark):
    df = spark.createDataFrame([(1, "s", 5.0), (1, "s", 5.0), (1, "s", 6.0)], "order_id int, sku string, price double")
    assert window.drop_exact_dups(df).count() == 2


def test_transaction_ids_and_suffixes(spark):
    df = spark.createDataFrame([(7, i) for i in range(3)] + [(8, 0)], "order_id int, n int")
    ids = [r["transaction_id"] for r in window.make_txn_id(df, "order_id", ["n"]).orderBy("order_id", "n").collect()]
    assert ids == ["7_001", "7_002", "7_003", "8_001"]
    assert [r["t"] for r in window.suffix_duplicates(df, "order_id", ["n"], "t").orderBy("order_id", "n").collect()] == ["7_1", "7_2", "7_3", "8"]


def test_snapshot_diff_classes(spark):
    b = spark.createDataFrame([("same", 1.0, True), ("moved", 1.0, True), ("gone", 1.0, False)], "k string, v double, sig boolean")
    a = spark.createDataFrame([("same", 1.0, True), ("moved", 1.1, False), ("fresh", 2.0, True)], "k string, v double, sig boolean")
    got = {r["k"]: (r["change"], r["significance_flip"]) for r in sets.snapshot_diff(b, a, ["k"], "v", "sig").collect()}
    assert got == {"same": ("unchanged", False), "moved": ("drifted", True), "gone": ("dropped", False), "fresh": ("new", False)}


def test_rollup_counts_source_rows_again(spark):
    df = spark.createDataFrame([("A", 1), ("B", 1), ("B", 2)], "line string, customer int")
    out = aggregate.with_rollup_all(df, "line").groupBy("line").agg(F.count_distinct("customer").alias("n"))
    assert {r["line"]: r["n"] for r in out.collect()} == {"A": 1, "B": 2, "all": 2}


def test_skewed_join_is_split(spark):
    """A key with most rows is split by the adaptive skew join, also below an aggregate."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("item"), F.col("id").alias("v"))
        m = hot.select("item").distinct().withColumn("product_line_id", F.lit("L"))
        out = lookup.fanout_map(hot.withColumn("product_line_id", F.lit("x")), m, "item")
        assert out.count() == 60000
        done = out.groupBy("item").agg(F.sum("v").alias("n"))
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
