"""Registered data-quality, storage and source queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.money import exact_sum
from martloom.operators import quality as dq
from martloom.operators.customer import by_customer, customer_by_date
from martloom.plans.commerce import REVIEWS_SQL, SALES_SQL, TOPICS, msum, order_lines, platform_of, products, reviews, sales, table
from martloom.plans.registry import query
from martloom.session import materialise, stage_path
from martloom.sources import files, headers, layers
from martloom.sources.layers import TableRef

S = "WITH " + SALES_SQL
STATUS = lambda m, other="FAIL": f"CASE WHEN {m} = 0 THEN 'PASS' ELSE '{other}' END"


def _row(check: str, measure: str, status: str, expected: str, source: str, name: str, platform: str = "'all'", tail: str = "") -> str:
    return f"SELECT {platform} AS platform_id, '{name}' AS table_name, '{check}' AS check_name, {status} AS status, '{expected}' AS expected, CAST({measure} AS DOUBLE) AS actual FROM {source} {tail}"


DUP = "COUNT(*) - COUNT(DISTINCT (order_id, line_number))"
BIG = "COUNT(*) FILTER (ABS(gross_price - quantity * retail_price) > 0.02)"


@query(
    "sales_quality_checks",
    "DQ1 DQ3 DQ4 DQ5 DQ6 DQ8 DQ9 DQ10",
    S + " "
    + " UNION ALL ".join(
        _row(c, m, st, e, "sales", "sales", "platform_id", "GROUP BY platform_id")
        for c, m, st, e in [
            ("row_count", "COUNT(*)", "CASE WHEN COUNT(*) >= 1 THEN 'PASS' ELSE 'FAIL' END", ">= 1"),
            ("null_customer_id", "0", "'PASS'", "0"),
            ("null_platform", "0", "'PASS'", "0"),
            ("empty_platform", "0", "'PASS'", "0"),
            ("foreign_platform", "COUNT(*) FILTER (platform_id NOT IN ('amz', 'cbz'))", STATUS("COUNT(*) FILTER (platform_id NOT IN ('amz', 'cbz'))"), "0"),
            ("duplicate_order_id_line_number", DUP, STATUS(DUP), "0"),
            ("line_total_matches", BIG, STATUS(BIG, "WARN"), "|difference| <= 0.02"),
            ("domain_order_status", "COUNT(*) FILTER (order_status NOT IN ('shipped', 'delivered'))", STATUS("COUNT(*) FILTER (order_status NOT IN ('shipped', 'delivered'))", "WARN"), "in shipped,delivered"),
            ("format_brand", "COUNT(*) FILTER (NOT REGEXP_MATCHES(brand, '^Brand#[0-9]$'))", STATUS("COUNT(*) FILTER (NOT REGEXP_MATCHES(brand, '^Brand#[0-9]$'))", "WARN"), "^Brand#[0-9]$"),
        ]
    ),
)
def sales_checks(spark, sf):
    checks = [
        dq.chk_rows(1),
        dq.chk_nulls("customer_id"),
        *dq.chk_platform(["amz", "cbz"]),
        dq.chk_dups(["order_id", "line_number"]),
        dq.chk_tolerance("line_total_matches", F.col("gross_price") - F.col("quantity") * F.col("retail_price")),
        dq.chk_domain("order_status", ["shipped", "delivered"]),
        dq.chk_pattern("brand", "^Brand#[0-9]$"),
    ]
    return dq.run_checks(sales(spark, sf), "sales", checks, by="platform_id")


@query(
    "required_columns_check",
    "DQ2 DQ3",
    "SELECT 'all' AS platform_id, 'orders' AS table_name, 'required_columns' AS check_name, 'FAIL' AS status, 'o_orderkey,o_custkey,ship_city' AS expected, 1.0::DOUBLE AS actual UNION ALL SELECT 'all', 'orders', 'row_count', 'PASS', '>= 1', CAST(COUNT(*) AS DOUBLE) FROM orders",
)
def required(spark, sf):
    o = table(spark, sf, "orders")
    return dq.chk_columns(o, "orders", ["o_orderkey", "o_custkey", "ship_city"]).unionByName(dq.run_checks(o, "orders", [dq.chk_rows(1)]))


@query(
    "table_relations_check",
    "DQ7",
    S + """, d AS (SELECT platform_id, product_line_id, customer_id, order_date FROM sales GROUP BY ALL), c AS (SELECT platform_id, product_line_id, customer_id FROM sales GROUP BY ALL), n AS (SELECT (SELECT COUNT(*) FROM d) + (SELECT COUNT(*) FROM (SELECT DISTINCT platform_id, customer_id, order_date FROM sales)) AS nd,
       (SELECT COUNT(*) FROM c) + (SELECT COUNT(*) FROM (SELECT DISTINCT platform_id, customer_id FROM sales)) AS nc)
      SELECT 'all' AS platform_id, 'by_date' AS table_name, 'rows >= by_customer' AS check_name, CASE WHEN nd >= nc THEN 'PASS' ELSE 'FAIL' END AS status, '>= ' || nc AS expected, CAST(nd AS DOUBLE) AS actual FROM n
      UNION ALL SELECT 'all', 'by_date', 'rows = by_customer', CASE WHEN nd = nc THEN 'PASS' ELSE 'FAIL' END, '= ' || nc, CAST(nd AS DOUBLE) FROM n""",
)
def relations(spark, sf):
    # both checks count both tables: computed once, written
    days = materialise(customer_by_date(sales(spark, sf)), "by-date")
    customers = materialise(by_customer(days), "by-customer")
    return dq.chk_relation(("by_date", days), ("by_customer", customers), ">=").unionByName(dq.chk_relation(("by_date", days), ("by_customer", customers), "="))


@query("status_outside_domain", "DQ9", "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 3)")
def outside(spark, sf):
    o = table(spark, sf, "orders")
    domain = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "o_orderpriority").limit(3).select("o_orderpriority")
    return dq.domain_outsiders(o, "o_orderpriority", domain)


@query("unique_order_keys", "DQ11", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def unique_keys(spark, sf):
    return dq.assert_pk(table(spark, sf, "orders"), ["o_orderkey"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "line_coverage_report",
    "DQ12",
    S + """, p AS (SELECT p_type, COUNT(DISTINCT p_partkey) AS n FROM part WHERE p_type <> 'SMALL' GROUP BY 1), c AS (SELECT p_type, COUNT(DISTINCT p_partkey) AS n FROM part WHERE p_brand > 'Brand#2' GROUP BY 1),
      s AS (SELECT product_line_id, COUNT(*) AS n FROM sales WHERE product_line_id <> 'LARGE' GROUP BY 1), d AS (SELECT product_line_id, COUNT(DISTINCT customer_id) AS n FROM sales GROUP BY 1)
      SELECT l.p_type AS product_line_id, COALESCE(p.n, 0) AS profile_items, COALESCE(c.n, 0) AS competitor_items, COALESCE(s.n, 0) AS sales_rows, COALESCE(d.n, 0) AS dna_rows,
      CASE WHEN COALESCE(p.n, 0) <= 0 THEN 'A_missing_profile_source' WHEN COALESCE(s.n, 0) <= 0 OR COALESCE(d.n, 0) <= 0 THEN 'B_profile_present_but_no_sales_coverage' ELSE 'OK' END AS gap_type
      FROM (SELECT DISTINCT p_type FROM part) l LEFT JOIN p USING (p_type) LEFT JOIN c USING (p_type) LEFT JOIN s ON s.product_line_id = l.p_type LEFT JOIN d ON d.product_line_id = l.p_type""",
)
def coverage(spark, sf):
    p = products(spark, sf).withColumnRenamed("product_id", "item_id")
    s = sales(spark, sf)
    dna = s.select("product_line_id", "customer_id").distinct()
    return dq.line_coverage(p, p.filter("product_line_id <> 'SMALL'"), p.filter("brand > 'Brand#2'"), s.filter("product_line_id <> 'LARGE'"), dna)


@query(
    "revenue_conservation",
    "DQ13",
    S + f""", a AS (SELECT *, CASE WHEN size = 7 THEN 'unclassified' ELSE product_line_id END AS line FROM sales WHERE quantity > 2), t AS (SELECT (SELECT {msum('lineproduct_price')} FROM sales) AS total_before, {msum('lineproduct_price')} AS total_after,
      CAST(SUM(CAST(CASE WHEN line = 'unclassified' THEN lineproduct_price ELSE 0 END AS DECIMAL(28,4))) AS DOUBLE) AS o FROM a)
      SELECT total_before, total_after, ABS(total_after - total_before) / total_before AS drift, o / total_after AS unclassified_ratio,
      CASE WHEN ABS(total_after - total_before) / total_before <= 0.005 THEN 'PASS' WHEN ABS(total_after - total_before) / total_before <= 0.05 THEN 'WARN' ELSE 'FAIL' END AS status FROM t""",
)
def conservation(spark, sf):
    s = sales(spark, sf)
    after = s.filter("quantity > 2").withColumn("product_line_id", F.when(F.col("size") == 7, "unclassified").otherwise(F.col("product_line_id")))
    return dq.conservation(s, after, "lineproduct_price")


@query(
    "filters_with_drop_counts",
    "DQ14",
    """SELECT 'quantity' AS filter, COUNT(*) AS rows_before, COUNT(*) FILTER (NOT COALESCE(l_quantity > 5, false)) AS dropped FROM lineitem
      UNION ALL SELECT 'discount', COUNT(*), COUNT(*) FILTER (NOT COALESCE(l_discount > 0, false)) FROM lineitem WHERE l_quantity > 5""",
)
def drop_counts(spark, sf):
    """Rows that each filter took, counted while the kept rows are written."""
    filters = {"quantity": F.col("l_quantity") > 5, "discount": F.col("l_discount") > 0}
    kept, seen = dq.with_drop_counts(table(spark, sf, "lineitem"), filters)
    materialise(kept, "filtered-lines")
    counts = seen.get
    left = [counts["rows_in"], *[counts[f"after_{name}"] for name in filters]]
    rows = [(name, before, before - after) for name, before, after in zip(filters, left, left[1:])]
    return spark.createDataFrame(rows, "filter string, rows_before long, dropped long")


@query(
    "gated_checks",
    "DQ15 CUS1",
    "SELECT 'all' AS platform_id, 'orders' AS table_name, 'row_count' AS check_name, 'PASS' AS status, '>= 10' AS expected, CAST(COUNT(*) AS DOUBLE) AS actual FROM orders UNION ALL SELECT 'all', 'orders', 'null_o_orderstatus', 'PASS', '0', 0.0 FROM orders HAVING COUNT(*) > 0",
)
def gated(spark, sf):
    return dq.gate(dq.run_checks(table(spark, sf, "orders"), "orders", [dq.chk_rows(10), dq.chk_nulls("o_orderstatus")]), "strict")


# ---- storage: whole tables are written to the shared folder and read back --------------------


def _root(spark: SparkSession) -> str:
    return stage_path(spark, "layers")


@query("layer_write_and_first_read", "SNK1 SRC1", "SELECT * FROM orders")
def first_read(spark, sf):
    root = _root(spark)
    ref = TableRef(root, "staged", "orders")
    layers.write_table(table(spark, sf, "orders"), ref)
    return layers.read_first(spark, [TableRef(root, "transformed", "orders"), ref])


@query("source_rows_since", "SRC8", "SELECT o_orderkey, l_linenumber, l_extendedprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate >= '1999-06-01'")
def since(spark, sf):
    o = layers.read_since(table(spark, sf, "orders"), "o_orderdate", "1999-06-01")
    li = table(spark, sf, "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey).select("o_orderkey", "l_linenumber", "l_extendedprice")


@query("platform_slice_replaced", "SNK3", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice * 2 ELSE o_totalprice END AS amount, CASE o_orderkey % 3 WHEN 0 THEN 'amz' WHEN 1 THEN 'cbz' ELSE 'eby' END AS platform_id FROM orders")
def slice_replaced(spark, sf):
    ref = TableRef(_root(spark), "app", "orders")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"), platform_of(F.col("o_orderkey")).alias("platform_id"))
    layers.write_platform_slice(o, ref)
    layers.write_platform_slice(o.filter("platform_id = 'cbz'").withColumn("amount", F.col("amount") * 2), ref)
    return spark.read.parquet(ref.path)


@query("line_partitions", "SNK8", S + " SELECT product_line_id, COUNT(*) AS n, SUM(quantity) AS quantity FROM sales GROUP BY 1")
def line_partitions(spark, sf):
    ref = TableRef(_root(spark), "app", "sales")
    layers.write_by_line(sales(spark, sf).select("product_line_id", "order_id", "quantity"), ref)
    return spark.read.parquet(ref.path).groupBy("product_line_id").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query("audit_appended", "SNK2 SNK4", "SELECT 'late' AS reason, o_orderkey AS row_id FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'large', o_orderkey FROM orders WHERE o_totalprice > 400000")
def audit_appended(spark, sf):
    ref = TableRef(_root(spark), "transformed", "audit")
    o = table(spark, sf, "orders")
    layers.append_audit(layers.empty_like(spark, "reason string, row_id long"), ref)
    layers.append_audit(o.filter("o_orderstatus = 'P'").select(F.lit("late").alias("reason"), F.col("o_orderkey").alias("row_id")), ref)
    layers.append_audit(o.filter("o_totalprice > 400000").select(F.lit("large").alias("reason"), F.col("o_orderkey").alias("row_id")), ref)
    return spark.read.parquet(ref.path)


@query("rolling_backup", "SNK5 PRD9", "SELECT 'backup' AS copy, COUNT(*) AS n, SUM(p_size)::BIGINT AS size FROM part UNION ALL SELECT 'current', COUNT(*), SUM(p_size + 1)::BIGINT FROM part")
def rolling_backup(spark, sf):
    ref = TableRef(_root(spark), "app", "part")
    p = table(spark, sf, "part")
    layers.backup_then_overwrite(p, ref)
    backup = layers.backup_then_overwrite(p.withColumn("p_size", F.col("p_size") + 1), ref)
    total = lambda path, name: spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")).select(F.lit(name).alias("copy"), "n", "size")
    return total(backup.path, "backup").unionByName(total(ref.path, "current"))


@query("layers_exported_as_csv", "SNK6", "SELECT n_nationkey AS key, n_name AS name, 'nation' AS entity FROM nation UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def exported(spark, sf):
    root, out = _root(spark), stage_path(spark, "csv")
    layers.write_table(table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name")), TableRef(root, "raw", "nation"))
    layers.write_table(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), TableRef(root, "app", "supplier"))
    done = layers.export_layers_csv(spark, root, out)
    read = lambda name: spark.read.option("header", True).schema("key long, name string").csv(f"{out}/{name}").withColumn("entity", F.lit(name.split("/")[1]))
    return read(done[0]).unionByName(read(done[1]))


@query("dated_reports", "SNK7", "SELECT 'latest' AS kind, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'kept ' || d, o_orderstatus, COUNT(*) FROM orders, (VALUES ('2024-02-10'), ('2024-02-20')) v(d) GROUP BY d, 2")
def reports(spark, sf):
    folder = stage_path(spark, "reports")
    r = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    for day in ("2024-01-01", "2024-02-10", "2024-02-20"):
        layers.write_report(r, folder, day, keep_days=30)
    runs = spark.read.parquet(f"{folder}/runs").select(F.concat(F.lit("kept "), F.date_format("run_day", "yyyy-MM-dd")).alias("kind"), "o_orderstatus", "n")
    return spark.read.parquet(f"{folder}/latest").select(F.lit("latest").alias("kind"), "o_orderstatus", "n").unionByName(runs)


# ---- sources ---------------------------------------------------------------------------------


def _drop_folder(spark: SparkSession, sf: str) -> str:
    """Reviews written as CSV into numbered folders, one per rating, with two header layouts."""
    folder = stage_path(spark, "drop") + "/reviews"
    r = reviews(spark, sf).select(F.col("review_id").cast("string").alias("review_id"), "rating", F.col("lang").alias("style"))
    for n in (1, 2, 3, 4, 5):
        part = r.filter(F.col("rating") == n)
        part = part.withColumnRenamed("style", "型號") if n % 2 else part.drop("style")
        part.write.option("header", True).csv(f"{folder}/{n:03d}")
    return folder


@query(
    "drop_folder_reviews",
    "SRC2 SRC3 SRC11 SRC5",
    "WITH " + REVIEWS_SQL + " SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(rating AS VARCHAR) AS rating, CASE WHEN rating % 2 = 1 THEN lang END AS style, ['ECONOMY','STANDARD','PROMO','LARGE','SMALL'][rating] AS product_line_id FROM reviews",
)
def drop_folder(spark, sf):
    raw = files.read_drop(spark, _drop_folder(spark, sf))
    named = headers.apply_aliases(raw, {"型號": "style"}, ["review_id", "rating", "style", "path"])
    return named.withColumn("product_line_id", files.line_from_path(F.col("path"), ["ECONOMY", "STANDARD", "PROMO", "LARGE", "SMALL"])).drop("path")


@query(
    "drop_folder_listing",
    "SRC2 SRC3",
    "WITH " + REVIEWS_SQL + """ SELECT DISTINCT printf('%03d', rating) AS folder, 'read' AS status, CASE WHEN rating % 2 = 1 THEN 'review_id|rating|型號' ELSE 'review_id|rating' END AS header FROM reviews
      UNION ALL SELECT DISTINCT 'sheets', 'spreadsheet not read', NULL FROM reviews UNION ALL SELECT DISTINCT 'notes', 'unwanted name', 'PK' FROM reviews""",
)
def drop_files(spark, sf):
    folder = _drop_folder(spark, sf)
    r = reviews(spark, sf)
    # a workbook under a CSV name, told by its first bytes; a text file under a name nobody asked for
    r.select(F.concat(F.lit("PK\u0003\u0004"), F.col("lang"))).write.csv(f"{folder}/sheets")
    r.select(F.lit("PK")).write.text(f"{folder}/notes")
    found = files.drop_listing(spark, folder).filter("length > 0")
    return found.select(files.parent_folder(F.col("path")).alias("folder"), "status", F.array_join("header", "|").alias("header")).distinct()


@query("drop_file_formats", "SRC3", "SELECT 'csv' AS format, COUNT(DISTINCT 1 + n_chars % 5) AS folders FROM documents")
def formats(spark, sf):
    found = files.detect_format(spark, _drop_folder(spark, sf)).filter(files.wanted(F.col("path")))
    return found.groupBy("format").agg(F.count_distinct(files.parent_folder(F.col("path"))).alias("folders"))


@query(
    "imported_file_reconciliation",
    "DQ16",
    "WITH " + REVIEWS_SQL + " SELECT rating AS folder, COUNT(*) AS n_rows, COUNT(*) AS rows_in, COUNT(DISTINCT review_id) AS keys_in, CASE WHEN rating = 3 THEN 'FAIL' ELSE 'PASS' END AS status FROM reviews GROUP BY 1",
)
def reconciliation(spark, sf):
    raw = files.read_drop(spark, _drop_folder(spark, sf))
    by = raw.withColumn("path", files.parent_folder(F.col("path")))
    manifest = reviews(spark, sf).groupBy(F.format_string("%03d", "rating").alias("path")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("review_id").alias("keys"))
    manifest = manifest.withColumn("keys", F.when(F.col("path") == "003", F.col("keys") - 1).otherwise(F.col("keys")))
    out = dq.reconcile_files(by, manifest, "review_id")
    return out.select(F.col("path").cast("int").alias("folder"), F.col("rows").alias("n_rows"), "rows_in", "keys_in", "status")


@query("monthly_files_aligned", "SRC4", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders WHERE YEAR(o_orderdate) <> 1998")
def monthly_files(spark, sf):
    folder = stage_path(spark, "monthly")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    kinds = {"plain": ("y not in (1996, 1998)", lambda df: df), "renamed": ("y = 1996", lambda df: df.withColumnRenamed("o_orderstatus", "o_status??")), "wide": ("y = 1998", lambda df: df.withColumn("extra", F.lit(1)))}
    for kind, (years, change) in kinds.items():
        change(o.filter(years)).write.partitionBy("y").option("header", True).csv(f"{folder}/{kind}")
    return files.read_monthly(spark, folder)[0]


@query("code_dictionary_names", "SRC7", "SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_totalprice AS payment_total, o_orderpriority AS other FROM orders")
def coded(spark, sf):
    raw = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ORD001"), F.col("o_orderdate").alias("ORD003"), F.col("o_totalprice").alias("ORD005"), F.col("o_orderpriority").alias("other"))
    return headers.rename_present(raw, headers.ORDER_CODES, ["order_id", "order_date"])


@query("normalised_headers", "SRC6", "SELECT o_orderkey AS legacy_order_id, o_custkey AS id, o_totalprice AS order_total_price, o_orderstatus AS total_price FROM orders")
def normalised(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("line_items.ID"), F.col("o_totalprice").alias("Total.Price"), F.col("o_orderstatus").alias("line_items.total.price")
    )
    return headers.clean_names(raw, "line_items.")


@query("review_header_aliases", "SRC5", "WITH " + REVIEWS_SQL + " SELECT CAST(review_date AS VARCHAR) AS date, rating, review_body AS body, product_id AS variation, CAST(NULL AS VARCHAR) AS author FROM reviews")
def aliases(spark, sf):
    raw = reviews(spark, sf).select(F.col("product_id").alias("ASIN"), F.col("review_date").cast("string").alias("評論時間"), F.col("rating").alias("星级"), F.col("review_body").alias("内容"))
    return headers.apply_aliases(raw, headers.REVIEW_ALIASES, headers.REVIEW_COLUMNS).select("date", "rating", "body", "variation", "author")


@query(
    "competitor_blocks",
    "SRC12",
    """SELECT 'LARGE' AS product_line_id, 'L' || LPAD(CAST(p_partkey AS VARCHAR), 9, '0') AS item_id, CASE WHEN p_size > 5 THEN p_brand ELSE 'UNKNOWN' END AS brand, CAST(p_size AS VARCHAR) AS sales_data, CAST(NULL AS VARCHAR) AS review_data, 'LARGE items' AS source_header FROM part
      UNION ALL SELECT 'SMALL', 'S' || LPAD(CAST(p_partkey AS VARCHAR), 9, '0'), 'Other', NULL, p_name, 'small goods' FROM part WHERE p_size > 20""",
)
def blocks(spark, sf):
    p = table(spark, sf, "part")
    code = lambda letter: F.concat(F.lit(letter), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    sheet = p.select(
        F.when(F.col("p_size") > 5, F.col("p_brand")).otherwise(" ").alias("品牌"), code("L").alias("LARGE items"), F.col("p_size").alias("銷售數據"),
        F.lit("Other").alias("品牌2"), F.when(F.col("p_size") > 20, code("S")).otherwise("-").alias("small goods"), F.col("p_name").alias("評論數據"),
    )
    return headers.blocks_to_long(sheet, {"LARGE": "LARGE", "SMALL": "small_goods_line"})
