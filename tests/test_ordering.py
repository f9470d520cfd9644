"""Ordered helpers against brute force, with one group holding most rows."""

from __future__ import annotations

import math
import random
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom import ordering


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    groups = ["hot"] * 700 + ["a"] * 40 + ["b"] * 3 + ["c"] + [None] * 5
    rows = [(g, float(rng.randint(0, 30)), i, rng.randint(1, 9)) for i, g in enumerate(groups)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double, id int, w int").repartition(6)
    return df, rows


def by_group(rows):
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    return {g: list(part) for g, part in groupby(keyed, key=lambda r: r[0])}


def test_ranked_matches_row_number(data):
    df, rows = data
    got = {r["id"]: (r["rn"], r["size"]) for r in ordering.ranked(df, ["g"], ["v", "id"], "rn", "size").collect()}
    want = {r[2]: (i, len(part)) for part in by_group(rows).values() for i, r in enumerate(part, 1)}
    assert got == want


def test_ranked_without_group_is_a_dense_id(data):
    df, rows = data
    got = [r["id"] for r in ordering.ranked(df, [], ["v", "id"], "rn").orderBy("rn").collect()]
    assert got == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]


def test_ranked_descending(data):
    df, rows = data
    got = {r["id"]: r["rn"] for r in ordering.ranked(df, ["g"], [F.col("v").desc(), "id"]).collect()}
    for part in by_group(rows).values():
        for i, r in enumerate(sorted(part, key=lambda r: (-r[1], r[2])), 1):
            assert got[r[2]] == i


def test_hot_group_is_spread_over_tasks(spark, data):
    df, _ = data
    # small test partitions would otherwise be merged again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = ordering.lay_out(df.filter("g = 'hot'"), ["g"], ["v", "id"])
        assert laid.select("_part").distinct().count() == 4
        largest = laid.groupBy("_part").count().agg(F.max("count")).first()[0]
        assert largest < 700 / 2
        for check in (test_ranked_matches_row_number, test_running_total, test_with_next_crosses_task_borders):
            check(data)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_total(data):
    df, rows = data
    got = {r["id"]: (r["run"], r["total"]) for r in ordering.running_total(df, ["g"], ["v", "id"], "w", "run", "total").collect()}
    for part in by_group(rows).values():
        run = 0
        for r in part:
            run += r[3]
            assert got[r[2]] == (run, sum(x[3] for x in part))


def test_with_next_crosses_task_borders(data):
    df, rows = data
    got = {r["id"]: r["next_w"] for r in ordering.with_next(df, ["g"], ["v", "id"], ["w"]).collect()}
    for part in by_group(rows).values():
        for r, nxt in zip(part, [*part[1:], None]):
            assert got[r[2]] == (nxt[3] if nxt else None)


@pytest.mark.parametrize("k", [2, 3, 5])
def test_tiles_follow_ntile(data, k):
    df, rows = data
    got = {r["id"]: r["t"] for r in ordering.with_tiles(df, ["g"], {"t": ("v", k)}, "id").collect()}
    for part in by_group(rows).values():
        base, extra = divmod(len(part), k)
        sizes = [base + (i < extra) for i in range(k)]
        want = [tile for tile, n in enumerate(sizes, 1) for _ in range(n)]
        assert [got[r[2]] for r in part] == want


def test_tiles_leave_null_metrics_null(spark):
    df = spark.createDataFrame([("x", 1.0, 1), ("x", None, 2), ("x", 3.0, 3)], "g string, v double, id int")
    got = {r["id"]: r["t"] for r in ordering.with_tiles(df, ["g"], {"t": ("v", 2)}, "id").collect()}
    assert got == {1: 1, 2: None, 3: 2}


def test_quantiles_interpolate(data):
    df, rows = data
    got = {r["g"]: (r["q1"], r["q2"]) for r in ordering.quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.9}).collect()}
    for g, part in by_group(rows).items():
        v = [r[1] for r in part]
        assert got[g] == pytest.approx((np.quantile(v, 0.25), np.quantile(v, 0.9)))


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "g string, v double, id int, w int")
    assert ordering.ranked(empty, ["g"], ["v", "id"]).count() == 0
    assert ordering.with_next(empty, ["g"], ["v", "id"], ["w"]).count() == 0
    assert ordering.with_tiles(empty, ["g"], {"t": ("v", 5)}, "id").count() == 0
    assert math.isclose(ordering.running_total(empty, ["g"], ["v", "id"], "w", "r", "t").count(), 0)


def test_one_hot_group_over_many_tasks(spark):
    from pyspark.sql import functions as F

    from martloom.ordering import positions

    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        # nearly all rows in one group, small ones before and after it, one of them null
        group = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 == 1, "z").when(F.col("id") % 50 == 2, "a").otherwise("hot")
        rows = spark.range(6000).select(group.alias("g"), (F.col("id") * 7 % 6000).alias("v"), (F.col("id") % 5).alias("w"))
        found = positions(rows, ["g"], ["v"], "rn", "w", "upto").toPandas()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    found["g"] = found["g"].fillna("none")
    found = found.sort_values(["g", "v"])
    assert (found.groupby("g").cumcount() + 1 == found["rn"]).all()
    assert (found.groupby("g")["w"].cumsum() == found["upto"]).all()
    assert len(found) == 6000


def test_histories_over_many_tasks(spark):
    from martloom.ordering import histories

    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    kinds = {0: None, 1: "z", 2: "a"}
    data = [(kinds.get(i % 50, "hot"), None if i % 1000 < 30 else i * 7 % 6000, i, i % 5) for i in range(6000)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = spark.createDataFrame(data, "g string, v long, id long, w long")
        found = histories(rows, ["g"], ["v", "id"], "rn", "w", "upto", "v", "begun", ["id"]).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    got = {r["id"]: (r["rn"], r["upto"], r["begun"], r["next_id"]) for r in found}
    assert len(found) == len(got) == 6000
    weight = {i: w for _, _, i, w in data}
    for g in (None, "z", "a", "hot"):
        part = sorted(((v is not None, v or 0, i) for h, v, i, _ in data if h == g))
        run, begun = 0, None
        for n, (some, v, i) in enumerate(part, 1):
            run += weight[i]
            begun = v if some and begun is None else begun
            assert got[i] == (n, run, begun, part[n][2] if n < len(part) else None)


def test_cuts_put_few_rows_in_order(spark, monkeypatch):
    # half of the rows share one value, some have no ident, some no number; one group is null
    rows = [(None if i % 9 == 0 else "g", float("nan") if i % 101 == 0 else 3.0 if i % 2 else (i * 37 % 4001) / 7 - 100, None if i % 997 == 0 else i) for i in range(20000)]
    df = spark.createDataFrame(rows, "g string, v double, id long")
    seen, own = [], ordering.positions

    def counted(rest, *args):
        seen.append(rest.count())
        return own(rest, *args)

    monkeypatch.setattr(ordering, "positions", counted)
    tiled = ordering.with_tiles(df, ["g"], {"t": ("v", 5)}, "id").collect()
    assert sum(seen) < 400
    for g in (None, "g"):
        part = sorted((r for r in tiled if r["g"] == g), key=lambda r: (math.isnan(r["v"]), 0 if math.isnan(r["v"]) else r["v"], r["id"] is not None, r["id"] or 0))
        base, extra = divmod(len(part), 5)
        assert [r["t"] for r in part if r["id"] is not None] == [tile for (tile, r) in zip([t for t in range(1, 6) for _ in range(base + (t <= extra))], part) if r["id"] is not None]
