"""Registered join and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.money import exact_sum
from martloom.operators import lookup
from martloom.operators.aggregate import review_stats
from martloom.plans.commerce import PLATFORM_SQL, REVIEWS_SQL, SALES_SQL, msum, order_lines, platform_of, products, reviews, rmean, sales, table
from martloom.plans.registry import query

S = "WITH " + SALES_SQL

# Two sellers reuse order ids: the seller is the platform, ids repeat after dividing by three.
OD_SQL = f"""o AS (SELECT CAST(FLOOR(o_orderkey / 3) AS BIGINT) AS order_id, {PLATFORM_SQL.format(k='o_orderkey')} || '@shop' AS seller_email, o_totalprice FROM orders),
d AS (SELECT CAST(FLOOR(l_orderkey / 3) AS BIGINT) AS order_id, {PLATFORM_SQL.format(k='l_orderkey')} || '@shop' AS batch_key, l_linenumber, l_partkey, l_quantity FROM lineitem)"""


def _orders_details(spark, sf):
    o, d = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    mail = lambda k: F.concat(platform_of(F.col(k)), F.lit("@shop"))
    short = lambda k: F.floor(F.col(k) / 3).cast("long").alias("order_id")
    return (
        o.select(short("o_orderkey"), mail("o_orderkey").alias("seller_email"), "o_totalprice"),
        d.select(short("l_orderkey"), mail("l_orderkey").alias("batch_key"), "l_linenumber", "l_partkey", "l_quantity"),
    )


@query("orders_with_details", "JN1", f"WITH {OD_SQL} SELECT o.order_id, seller_email, o_totalprice, batch_key, l_linenumber, l_partkey, l_quantity FROM o JOIN d ON o.order_id = d.order_id AND seller_email = batch_key")
def orders_details(spark, sf):
    return lookup.join_order_details(*_orders_details(spark, sf))


@query(
    "join_key_diagnostics",
    "JN2",
    f"""WITH {OD_SQL}, b AS (SELECT order_id, COUNT(*) AS nb FROM o GROUP BY 1), p AS (SELECT order_id, COUNT(*) AS np FROM d GROUP BY 1)
      SELECT COUNT(*) FILTER (nb > 1) AS duplicate_build_keys, CAST(0 AS BIGINT) AS null_key_rows, COUNT(*) FILTER (nb IS NOT NULL AND np IS NOT NULL) AS shared_keys,
        ROUND(CAST(SUM(np) FILTER (nb IS NOT NULL) * 100 AS DOUBLE) / SUM(np), 6) AS coverage_pct, 'PASS' AS status FROM b FULL JOIN p USING (order_id)""",
)
def diagnostics(spark, sf):
    o, d = _orders_details(spark, sf)
    return lookup.join_diagnostics(o, d, ["order_id"]).withColumn("coverage_pct", F.round("coverage_pct", 6))


CASCADE_SQL = """ (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN ' known ' WHEN l_linenumber = 2 THEN ' ' END AS product_line_id,
  'S' || l_partkey AS sku, CAST(l_suppkey AS VARCHAR) AS asin FROM lineitem) raw"""


def _cascade_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 1, " known ").when(F.col("l_linenumber") == 2, " ").alias("product_line_id"),
        F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_suppkey").cast("string").alias("asin"),
    )


@query(
    "product_line_cascade",
    "JN3",
    f"""WITH sku_map AS (SELECT 'S' || p_partkey AS sku, p_type AS v FROM part WHERE p_size <= 20),
      asin_map AS (SELECT CAST(l_suppkey AS VARCHAR) AS asin, MIN(p_type) AS v FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 48 GROUP BY 1),
      profile_map AS (SELECT 'S' || p_partkey AS sku, 'profile ' || p_type AS v FROM part WHERE p_size > 30)
    SELECT l_orderkey, l_linenumber, sku, asin, COALESCE(NULLIF(TRIM(product_line_id), ''), a.v, b.v, c.v) AS product_line_id,
      CASE WHEN TRIM(product_line_id) <> '' THEN 'present' WHEN a.v IS NOT NULL THEN 'sku' WHEN b.v IS NOT NULL THEN 'asin' WHEN c.v IS NOT NULL THEN 'profile' END AS filled_by
    FROM {CASCADE_SQL} LEFT JOIN sku_map a USING (sku) LEFT JOIN asin_map b USING (asin) LEFT JOIN profile_map c USING (sku)""",
)
def cascade(spark, sf):
    p = products(spark, sf)
    sku = F.concat(F.lit("S"), F.col("product_id").cast("string")).alias("sku")
    sku_map = p.filter("size <= 20").select(sku, "product_line_id")
    sold = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").cast("string").alias("asin"))
    asin_map = sold.join(p.filter("size > 48"), "product_id").select("asin", "product_line_id")
    profile_map = p.filter("size > 30").select(sku, F.concat(F.lit("profile "), "product_line_id").alias("product_line_id"))
    return lookup.fill_from_maps(
        _cascade_rows(spark, sf), [("sku", sku_map, "sku", "sku"), ("asin", asin_map, "asin", "asin"), ("profile", profile_map, "sku", "sku")]
    )


@query(
    "product_line_cascade_counts",
    "JN4",
    f"""WITH m AS (SELECT 'S' || p_partkey AS sku, CAST(p_partkey % 100 AS VARCHAR) AS item_id, p_type FROM part WHERE p_size <= 10),
      s AS (SELECT sku, MIN(p_type) AS v FROM m GROUP BY 1), i AS (SELECT item_id, MIN(p_type) AS v FROM m GROUP BY 1)
    SELECT CASE WHEN TRIM(product_line_id) <> '' THEN 'present' WHEN s.v IS NOT NULL THEN 'sku' WHEN i.v IS NOT NULL THEN 'item' END AS filled_by, COUNT(*) AS n
    FROM {CASCADE_SQL} LEFT JOIN s USING (sku) LEFT JOIN i ON i.item_id = raw.asin GROUP BY 1""",
)
def cascade_two(spark, sf):
    p = products(spark, sf).filter("size <= 10")
    mapping = p.select(
        F.concat(F.lit("S"), F.col("product_id").cast("string")).alias("sku"), (F.col("product_id") % 100).cast("string").alias("item_id"), "product_line_id"
    )
    rows = _cascade_rows(spark, sf).withColumnRenamed("asin", "item_id")
    return lookup.fill_from_mapping(rows, mapping).groupBy("filled_by").agg(F.count(F.lit(1)).alias("n"))


# A supplier sells in every line it has parts of: items with several lines.
MAP_SQL = "map AS (SELECT DISTINCT l_suppkey AS item_id, p_type AS product_line_id FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size < 6)"


def _supplier_lines(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("item_id"), F.col("l_partkey").alias("product_id"))
    return li.join(products(spark, sf).filter("size < 6"), "product_id").select("item_id", "product_line_id")


@query(
    "fanout_line_sales",
    "JN5",
    f"WITH {MAP_SQL} SELECT product_line_id, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem LEFT JOIN map ON item_id = l_suppkey GROUP BY 1",
)
def fanout(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("item_id"), F.lit(None).cast("string").alias("product_line_id"), "l_quantity")
    out = lookup.fanout_map(li, _supplier_lines(spark, sf), "item_id")
    return out.groupBy("product_line_id").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query(
    "line_aware_profile",
    "JN6 JN7",
    f"""WITH {MAP_SQL}, prof AS (SELECT item_id, product_line_id, item_id || ' in ' || product_line_id AS profile FROM map WHERE item_id % 2 = 0)
      SELECT m.item_id, m.product_line_id, profile FROM map m LEFT JOIN prof p ON p.item_id = m.item_id AND p.product_line_id = m.product_line_id""",
)
def line_profile(spark, sf):
    m = _supplier_lines(spark, sf).distinct()
    prof = m.filter("item_id % 2 = 0").withColumn("profile", F.concat(F.col("item_id").cast("string"), F.lit(" in "), "product_line_id"))
    return lookup.enrich_profile(m, prof, "item_id")


@query(
    "series_with_reviews",
    "JN8 AGG2",
    S + ", " + REVIEWS_SQL + f""", st AS (SELECT product_id, COUNT(*) AS review_count, {rmean('CASE WHEN review_id % 4 > 0 THEN rating END')} AS avg_helpful FROM reviews GROUP BY 1)
    SELECT product_id, product_line_id, SUM(quantity) AS sales, COALESCE(ANY_VALUE(review_count), 0) AS review_count, ROUND(ANY_VALUE(avg_helpful), 6) AS avg_helpful
    FROM sales LEFT JOIN st USING (product_id) GROUP BY 1, 2""",
)
def series_reviews(spark, sf):
    r = reviews(spark, sf).withColumn("helpful", F.when(F.col("review_id") % 4 > 0, F.col("rating")))
    totals = sales(spark, sf).groupBy("product_id", "product_line_id").agg(F.sum("quantity").alias("sales"))
    return lookup.enrich_reviews(totals, review_stats(r, "product_id", "helpful"), "product_id").withColumn("avg_helpful", F.round("avg_helpful", 6))


@query(
    "missing_items_backfilled",
    "JN10",
    """WITH known AS (SELECT p_type AS product_line_id, p_partkey AS item_id, p_brand AS brand, 'sheet' AS source_header FROM part WHERE p_size < 25)
      SELECT * FROM known UNION SELECT p_type, p_partkey, 'UNKNOWN', 'profile_backfill' FROM part WHERE p_size > 20 AND p_partkey NOT IN (SELECT item_id FROM known)""",
)
def backfilled(spark, sf):
    p = products(spark, sf).withColumnRenamed("product_id", "item_id")
    known = p.filter("size < 25").select("product_line_id", "item_id", "brand", F.lit("sheet").alias("source_header"))
    return lookup.antijoin_backfill(p.filter("size > 20"), known, ["product_line_id", "item_id"])


@query(
    "key_reconciliation",
    "JN11",
    """SELECT p_partkey AS item_id, 'missing_locally' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)
      UNION ALL SELECT DISTINCT l_partkey, 'extra_locally' FROM lineitem WHERE l_quantity > 48 AND l_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def reconciliation(spark, sf):
    parts = products(spark, sf).select(F.col("product_id").alias("item_id"))
    sold = table(spark, sf, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("item_id"))
    return lookup.reconcile_keys(parts, sold, ["item_id"])


@query("competitor_flagged_reviews", "JN12", "WITH " + REVIEWS_SQL + " SELECT review_id, product_id, product_id IN (SELECT p_partkey FROM part WHERE p_brand NOT IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')) AS included FROM reviews")
def flagged(spark, sf):
    rivals = products(spark, sf).filter("not is_own").select("product_id")
    return lookup.flag_membership(reviews(spark, sf).select("review_id", "product_id"), rivals, ["product_id"], "included")


@query(
    "reviews_joined_by_url",
    "JN13",
    "SELECT page_id, p_partkey FROM (SELECT page_id, NULLIF(REGEXP_EXTRACT(url, '/(\\d+)', 1), '') AS k FROM pages) JOIN part ON k = CAST(p_partkey AS VARCHAR)",
)
def by_url(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return lookup.join_reviews_items(pages, table(spark, sf, "part").select("p_partkey"), r"/(\d+)", "p_partkey").select("page_id", "p_partkey")


@query(
    "line_names",
    "JN14",
    "SELECT p_partkey AS product_id, CASE WHEN p_type < 'M' THEN 'local ' || p_type ELSE LOWER(p_type) END AS product_line_name FROM part",
)
def names(spark, sf):
    p = products(spark, sf)
    dim = p.select("product_line_id").distinct().select(
        "product_line_id", F.when(F.col("product_line_id") < "M", F.concat(F.lit("local "), "product_line_id")).otherwise(" ").alias("name_local"), F.lower("product_line_id").alias("name_en")
    )
    return lookup.with_line_name(p, dim).select("product_id", "product_line_name")


@query(
    "collision_safe_join",
    "JN15",
    "SELECT p_partkey AS item_id, p_size AS size_profile, p_name AS name, n AS size FROM part LEFT JOIN (SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey",
)
def collision(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_size").alias("size"), F.col("p_name").alias("name"))
    n = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(F.count(F.lit(1)).alias("size"))
    return lookup.join_suffix(p, n, ["item_id"])


@query(
    "sales_by_source_priority",
    "JN16 AGG3",
    S + """, own AS (SELECT product_id, SUM(quantity) AS q FROM sales WHERE is_own AND platform_id = 'amz' GROUP BY 1), comp AS (SELECT product_id, SUM(quantity) AS q FROM sales WHERE platform_id = 'eby' GROUP BY 1)
      SELECT p_partkey AS product_id, COALESCE(own.q, comp.q, 0.0) AS sales, CASE WHEN own.q IS NOT NULL THEN 'own' WHEN comp.q IS NOT NULL THEN 'competitor' ELSE 'none' END AS sales_source
      FROM part LEFT JOIN own ON own.product_id = p_partkey LEFT JOIN comp ON comp.product_id = p_partkey""",
)
def sales_priority(spark, sf):
    from martloom.operators.aggregate import item_totals

    s = sales(spark, sf)
    own = item_totals(s.filter("is_own and platform_id = 'amz'"), "product_id", out="sales")
    comp = item_totals(s.filter("platform_id = 'eby'"), "product_id", out="sales")
    return lookup.fill_sales(products(spark, sf).select("product_id"), own, comp, "product_id")


@query(
    "customer_id_registry",
    "JN17",
    """WITH k AS (SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'amz' WHEN 1 THEN 'cbz' ELSE 'eby' END AS platform_id, c_name AS natural_key, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey),
      old AS (SELECT platform_id, natural_key, ROW_NUMBER() OVER (ORDER BY platform_id, natural_key) AS customer_id FROM k WHERE c_nationkey < 12),
      fresh AS (SELECT platform_id, natural_key, (SELECT MAX(customer_id) FROM old) + ROW_NUMBER() OVER (ORDER BY platform_id, natural_key) AS customer_id FROM k WHERE c_nationkey >= 12)
      SELECT * FROM old UNION ALL SELECT * FROM fresh""",
)
def registry(spark, sf):
    named = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("natural_key"), "c_nationkey")
    seen = table(spark, sf, "orders").select(platform_of(F.col("o_orderkey")).alias("platform_id"), F.col("o_custkey").alias("c_custkey")).join(named, "c_custkey")
    key = ["platform_id", "natural_key"]
    empty = spark.createDataFrame([], "platform_id string, natural_key string, customer_id long")
    _, first = lookup.assign_ids(seen.filter("c_nationkey < 12"), key, empty)
    _, grown = lookup.assign_ids(seen, key, first)
    return grown


NAMES_SQL = "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_type WHEN 1 THEN ' ' || LOWER(p_type) || ' line' WHEN 2 THEN 'Local ' || p_type ELSE CASE WHEN p_size > 40 THEN 'nowhere' ELSE '' END END AS label, p_type, p_size FROM part"


def _labelled(spark, sf):
    k, line = F.col("size") % 4, F.col("product_line_id")
    p = products(spark, sf)
    label = (
        F.when(k == 0, line)
        .when(k == 1, F.concat(F.lit(" "), F.lower(line), F.lit(" line")))
        .when(k == 2, F.concat(F.lit("Local "), line))
        .otherwise(F.when(F.col("size") > 40, "nowhere").otherwise(""))
    )
    dim = p.select("product_line_id").distinct().withColumn("name_en", F.concat(line, F.lit(" line"))).withColumn("name_local", F.concat(F.lit("local "), line))
    return lookup.resolve_line(p.select("product_id", label.alias("label")), dim, "label")


@query("line_name_resolution", "JN18", f"SELECT p_partkey AS product_id, label, CASE WHEN p_size % 4 < 3 THEN p_type END AS product_line_id FROM ({NAMES_SQL})")
def resolution(spark, sf):
    return _labelled(spark, sf)[0]


@query("line_name_unresolved", "JN18", f"SELECT DISTINCT label FROM ({NAMES_SQL}) WHERE label = 'nowhere'")
def unresolved(spark, sf):
    return _labelled(spark, sf)[1]


@query(
    "foreign_key_violations",
    "JN20",
    "SELECT DISTINCT l_partkey AS item_id, l_returnflag AS marketplace FROM lineitem WHERE (l_partkey, l_returnflag) NOT IN (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'R' END FROM part)",
)
def violations(spark, sf):
    child = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item_id"), F.col("l_returnflag").alias("marketplace"))
    parent = products(spark, sf).select(F.col("product_id").alias("item_id"), F.when(F.col("size") % 2 == 0, "A").otherwise("R").alias("marketplace"))
    return lookup.fk_violations(child, parent, ["item_id", "marketplace"])


@query(
    "revenue_by_nation",
    "AGG1 AGG3",
    S + f" SELECT n_name, r_name, {msum('lineproduct_price')} AS revenue, COUNT(DISTINCT order_id) AS orders FROM sales JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2",
)
def by_nation(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    s = order_lines(spark, sf).select("customer_id", "order_id", "lineproduct_price")
    return (
        s.join(c, F.col("customer_id") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("n_name", "r_name")
        .agg(exact_sum("lineproduct_price").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    )
