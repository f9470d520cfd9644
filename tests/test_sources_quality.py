from __future__ import annotations

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import products, quality as dq, recommend, reviews, segments
from martloom.sources import files, headers, layers
from martloom.sources.layers import TableRef


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="martloom-test-"))


def test_files_are_classified_by_content(spark, folder):
    (folder / "table.csv").write_text("a,b\n1,2\n")
    (folder / "no_extension").write_bytes(b"PK\x03\x04rest")
    (folder / "old.xls").write_bytes(bytes.fromhex("D0CF11E0A1B11AE1") + b"x")
    (folder / "note.txt").write_text("x")
    got = {Path(r["path"]).name: r["format"] for r in files.detect_format(spark, str(folder)).collect()}
    assert got == {"table.csv": "csv", "no_extension": "xlsx", "old.xls": "xls", "note.txt": "csv"}
    names = spark.createDataFrame([(n,) for n in ["/d/a.csv", "/d/plain", "/d/.hid.csv", "/d/_x.csv", "/d/n.txt", "/d/B.XLSX"]], "p string")
    assert [r[0] for r in names.filter(files.wanted(F.col("p"))).collect()] == ["/d/a.csv", "/d/plain", "/d/B.XLSX"]


def test_drop_folder_unions_by_name(spark, folder):
    (folder / "1.csv").write_text("a,b\n1,2\n3,4\n")
    (folder / "2").write_text("b,c\n5,6\n")
    (folder / "skip.txt").write_text("x\n1\n")
    got = files.read_drop(spark, str(folder))
    assert sorted(got.columns) == ["a", "b", "c", "path"]
    assert sorted((r["a"], r["b"], r["c"]) for r in got.collect() if r["a"]) == [("1", "2", None), ("3", "4", None)]
    assert got.count() == 3


def test_header_of_a_file_with_many_splits(spark, folder):
    body = "".join(f"{i},{'x' * 20}\n" for i in range(4000))
    (folder / "long.csv").write_text("id,filler\n" + body)
    (folder / "short.csv").write_text("id,filler\n-1,y\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        assert list(files.layouts(spark, str(folder))) == [("id", "filler")]
        assert files.read_drop(spark, str(folder)).count() == 4001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_with_quoted_commas_blank_lines_and_repeats(spark, folder):
    (folder / "a b%.csv").write_text('\ufeff"id","price, net","he said ""x""",,a,A\n1,"2,5","q""q",4,5,6\n')
    (found,) = files.layouts(spark, str(folder))
    assert found == ("id", "price, net", 'he said "x"', "_c3", "a4", "A5")
    (row,) = files.read_drop(spark, str(folder)).drop("path").collect()
    assert tuple(row) == ("1", "2,5", 'q"q', "4", "5", "6")


def test_only_the_first_kilobytes_are_read(folder):
    read = []

    def part(text):
        return lambda at, size: read.append((at, size)) or text[at : at + size]

    assert files.first_line(part(b"a,b\r\n" + b"x" * 1000), 1005, 64) == b"a,b" and read == [(0, 64)]
    read.clear()
    assert files.first_line(part(b"c" * 200 + b"\n1"), 202, 64) == b"c" * 200 and len(read) == 4  # a header longer than a part
    assert files.first_line(part(b"\n \n" + b"d"), 4, 2) == b"d"
    assert files.first_line(part(b""), 0, 64) == b""


def test_a_file_of_three_gigabytes_is_probed_by_its_start(spark, folder):
    with open(folder / "huge.csv", "wb") as f:  # sparse: takes no room
        f.write(b"id,text\n1,x\n")
        f.truncate(3 << 30)
    (row,) = files.probe_files(spark, str(folder)).collect()
    assert (row.length, row.format, row.header) == (3 << 30, "csv", ["id", "text"])


def test_spreadsheets_beside_text_files_are_listed(spark, folder):
    (folder / "a.csv").write_text("x\n1\n")
    (folder / "book.xlsx").write_bytes(b"PK\x03\x04rest")
    (folder / "book.csv").write_bytes(b"PK\x03\x04rest")  # named like a text file
    (folder / "old.xls").write_bytes(bytes.fromhex("D0CF11E0A1B11AE1") + b"x")
    (folder / "list.xls").write_text("x\n2\n")  # text under a spreadsheet's name
    (folder / "none.csv").write_text("\n\n")
    (folder / "n.txt").write_text("x\n")
    got = {Path(r.path).name: r.status for r in files.drop_listing(spark, str(folder)).collect()}
    sheet = "spreadsheet not read"
    assert got == {"a.csv": "read", "list.xls": "read", "book.xlsx": sheet, "book.csv": sheet, "old.xls": sheet, "none.csv": "empty", "n.txt": "unwanted name"}
    assert sorted(r.x for r in files.read_drop(spark, str(folder)).collect()) == ["1", "2"]


def test_monthly_files_take_one_scan_per_header(spark, folder):
    for m in range(12):
        (folder / f"{m:02d}.csv").write_text("a,b\n1,2\n" if m != 3 else "a,b?\n3,4\n")
    (folder / "99.csv").write_text("a,b,c\n5,6,7\n")
    out, dropped = files.read_monthly(spark, str(folder))
    assert sorted(tuple(r) for r in out.collect()) == [("1", "2")] * 11 + [("3", "4")]
    assert [Path(p).name for p in dropped] == ["99.csv"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_files_follow_bytes_not_tasks_times_folders(spark, folder):
    rows = spark.range(0, 60000, 1, 30).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 10)).alias("product_line_id"), F.xxhash64("id").alias("v"))
    ref = TableRef(str(folder), "app", "lines")
    layers.write_by_line(rows, ref)
    count = lambda: {d.name: len(list(d.glob("*.parquet"))) for d in (folder / "app" / "lines").iterdir() if d.is_dir()}
    assert set(count().values()) == {1}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        layers.write_by_line(rows, ref)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert count()["product_line_id=hot"] > 2 and count()["product_line_id=l8"] <= 2  # the hot folder is split, the others aren't
    assert spark.read.parquet(ref.path).count() == 60000


def test_modal_schema(spark):
    f = lambda cols, vals: spark.createDataFrame([vals], cols)
    frames = {"jan": f(["a", "b"], [1, 2]), "feb": f(["a", "b"], [3, 4]), "bad_head": f(["a", "b??"], [5, 6]), "wide": f(["a", "b", "c"], [7, 8, 9]), "swapped": f(["b", "a"], [10, 11])}
    out, dropped = headers.align_by_modal_schema(frames)
    assert dropped == ["wide"]
    assert {(r["a"], r["b"]) for r in out.collect()} >= {(1, 2), (3, 4), (5, 6)}


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["ASIN", "asin", "星级"])
    out = headers.apply_aliases(df, headers.REVIEW_ALIASES, ["variation", "rating", "url"])
    assert tuple(out.first()) == (1, 3, None)
    df = spark.createDataFrame([(1, 2, 3)], ["id", "line_items.id", "Buyer.Name"])
    assert headers.clean_names(df, "line_items.").columns == ["legacy_order_id", "id", "buyer_name"]
    with pytest.raises(ValueError):
        headers.rename_present(df, headers.ORDER_CODES, ["order_id"])
    assert headers.resolve_header("hair dryer", ["dryer for hair, new", "fan"]) == "dryer for hair, new"
    assert headers.resolve_header("zzz", ["a", "b"]) is None


def test_layers(spark, folder):
    ref = TableRef(str(folder), "app", "t")
    df = spark.createDataFrame([(1, "amz"), (2, "eby")], "v int, platform_id string")
    assert layers.write_table(df, ref) == 2 == layers.write_table(df, ref)
    with pytest.raises(FileNotFoundError):
        layers.read_first(spark, [TableRef(str(folder), "raw", "t")])
    part = TableRef(str(folder), "app", "p")
    layers.write_platform_slice(df, part)
    layers.write_platform_slice(df.filter("platform_id = 'amz'").withColumn("v", F.lit(9)), part)
    assert sorted((r["platform_id"], r["v"]) for r in spark.read.parquet(part.path).collect()) == [("amz", 9), ("eby", 2)]
    for name in ("t_backup_20240101", "t_backup_rolling"):
        df.write.parquet(f"{folder}/app/{name}")
    assert layers.purge_dated_backups(spark, str(folder), "app", "t") == ["t_backup_20240101"]
    assert layers.empty_like(spark, "a int, b string").dtypes == [("a", "int"), ("b", "string")]


def test_read_since_is_pushed_down(spark, folder):
    spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d")).write.parquet(f"{folder}/s")
    out = layers.read_since(spark.read.parquet(f"{folder}/s"), "d", "2024-01-06")
    assert out.count() == 5
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2024-01-06)]" in out._jdf.queryExecution().executedPlan().toString()


def test_checks_and_gate(spark):
    df = spark.createDataFrame([("amz", 1, "a"), ("amz", 1, None), (None, 2, " ")], "platform_id string, k int, name string")
    checks = [dq.chk_rows(4), dq.chk_nulls("name"), *dq.chk_platform(["amz"]), dq.chk_dups(["k"])]
    got = {r["check_name"]: (r["status"], r["actual"]) for r in dq.run_checks(df, "t", checks).collect()}
    assert got["row_count"] == ("FAIL", 3.0) and got["null_name"] == ("FAIL", 2.0)
    assert got["null_platform"] == ("FAIL", 1.0) and got["foreign_platform"] == ("PASS", 0.0) and got["duplicate_k"] == ("FAIL", 1.0)
    results = dq.run_checks(df, "t", checks)
    assert dq.gate(results) is results
    with pytest.raises(ValueError):
        dq.gate(results, "strict")
    with pytest.raises(ValueError):
        dq.assert_pk(df, ["k"])
    assert dq.chk_columns(df, "t", ["zip"]).first()["status"] == "FAIL"


def test_drop_counts(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (9,)], "v int")
    kept, seen = dq.with_drop_counts(df, {"big": F.col("v") > 2, "small": F.col("v") < 8})
    assert kept.count() == 1
    assert seen.get == {"rows_in": 4, "after_big": 2, "after_small": 1}


def test_pending_retries_failed_and_skips_done(spark):
    frame = spark.createDataFrame([(i, "t", "m") for i in range(4)], "review_id int, topic string, model string")
    res = spark.createDataFrame(
        [(0, "t", "m", 1, "3"), (1, "t", "m", 1, "Connection_error"), (2, "t", "m", 1, "4"), (2, "t", "m", 2, "timeout")], "review_id int, topic string, model string, rated_at int, result string"
    )
    assert sorted(r["review_id"] for r in reviews.pending(frame, res).collect()) == [1, 2, 3]
    h = {(r["review_id"], r["valid_from"]): (r["valid_to"], r["is_current"]) for r in reviews.result_history(res).collect()}
    assert h[2, 1] == (2, False) and h[2, 2] == (None, True)


def test_transitions_and_chains(spark):
    rows = [(c, t, t, 1, p) for c, seq in {1: [1, 2, 2, 3], 2: [1, 2, 1], 3: [1, 3]}.items() for t, p in enumerate(seq)]
    df = spark.createDataFrame(rows, "customer_id int, payment_time int, order_id int, line_number int, product_id int")
    got = {(r["from_product"], r["to_product"]): r["probability"] for r in recommend.transitions(df).collect()}
    assert got == {(1, 2): pytest.approx(2 / 3), (1, 3): pytest.approx(1 / 3), (2, 3): 0.5, (2, 1): 0.5}
    chains = {r["product_id"]: r["chain"] for r in recommend.rec_chain(df, recommend.transitions(df)).collect()}
    assert chains == {1: [1, 2, 3], 2: [2, 1, 3], 3: [3]}


def test_segments_are_ordered_by_size(spark):
    rows = [("L", i, 5.0 + i, 0.0 + i % 3 * 0.01, 0.0) for i in range(20)] + [("L", 100 + i, 1.0, 9.0 + i % 2 * 0.01, 5.0) for i in range(5)] + [("M", 1, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "product_line_id string, product_id int, sales double, a double, b double")
    got = segments.segment_market(df, ["a", "b"], k=2).collect()
    assert {r["cluster"] for r in got if r["product_line_id"] == "L" and r["product_id"] < 100} == {1}
    assert {r["cluster"] for r in got if r["product_id"] >= 100} == {2}
    assert [r["cluster"] for r in got if r["product_line_id"] == "M"] == [1]


def test_changed_cells(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "cell string, fingerprint string")
    old = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "cell string, fingerprint string")
    assert {r["cell"]: r["state"] for r in segments.changed_cells(new, old, ["cell"]).collect()} == {"b": "changed", "c": "new", "d": "vanished"}


def test_imputation_falls_back_to_the_topic(spark):
    df = spark.createDataFrame([("L", 1, "t", 2.0), ("L", 2, "t", None), ("M", 3, "t", None)], "product_line_id string, product_id int, topic string, rating double")
    got = {r["product_id"]: (r["rating"], r["imputed"]) for r in reviews.impute(df).collect()}
    assert got == {1: (2.0, False), 2: (2.0, True), 3: (2.0, True)}


def test_product_tables(spark):
    a = spark.createDataFrame([("s", "i", "L2")], "sku string, item_id string, product_line_id string")
    b = spark.createDataFrame([("s", "i", "L1"), ("r", "i", "L1")], "sku string, item_id string, product_line_id string")
    got = [(r["mapping_id"], r["sku"], r["product_line_id"]) for r in products.product_mapping([a, b]).orderBy("mapping_id").collect()]
    assert got == [(1, "r", "L1"), (2, "s", "L2")]
    with pytest.raises(ValueError):
        products.line_dim(spark.createDataFrame([("x",)], " name_en string"))


def test_swapped_valid_headers_keep_their_values(spark):
    plain, swapped = (spark.createDataFrame([row], names) for row, names in (((1, 2), ["a", "b"]), ((20, 10), ["b", "a"])))
    out, dropped = headers.align_by_modal_schema({"one": plain, "two": plain, "three": swapped})
    assert not dropped and {(r["a"], r["b"]) for r in out.collect()} == {(1, 2), (10, 20)}
