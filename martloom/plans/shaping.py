"""Registered aggregate, window, sort and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.money import exact_mean, exact_sum
from martloom.operators import aggregate as agg
from martloom.operators import sets, window
from martloom.plans.commerce import REVIEWS_SQL, SALES_SQL, msum, order_lines, products, reviews, rmean, sales, table
from martloom.plans.registry import query

S = "WITH " + SALES_SQL
R = "WITH " + REVIEWS_SQL


@query("daily_item_sales", "AGG1", S + f" SELECT product_id, product_line_id, order_date, SUM(quantity) AS sales, {msum('lineproduct_price')} AS sales_platform FROM sales GROUP BY 1, 2, 3")
def daily(spark, sf):
    return agg.daily_sales(sales(spark, sf))


@query("review_counts", "AGG2", R + f" SELECT product_id, COUNT(*) AS review_count, {rmean('rating')} AS avg_helpful FROM reviews GROUP BY 1")
def review_counts(spark, sf):
    return agg.review_stats(reviews(spark, sf), "product_id", "rating")


@query("item_lifetime_totals", "AGG3", "SELECT l_partkey, SUM(l_quantity) AS total_sales FROM lineitem GROUP BY 1")
def item_totals(spark, sf):
    return agg.item_totals(table(spark, sf, "lineitem"), "l_partkey", "l_quantity")


@query(
    "distinct_counts",
    "AGG4",
    S + " SELECT platform_id, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS items, COUNT(DISTINCT order_id) AS orders FROM sales GROUP BY 1",
)
def distincts(spark, sf):
    return agg.n_distinct(order_lines(spark, sf), {"customers": "customer_id", "items": "product_id", "orders": "order_id"}, ["platform_id"])


@query(
    "conditional_counts",
    "AGG5",
    "SELECT l_returnflag, COUNT(*) AS n_rows, COUNT(*) FILTER (l_discount > 0.05) AS discounted, COUNT(*) FILTER (l_quantity >= 40) AS bulk, COUNT(*) FILTER (l_tax = 0) AS untaxed FROM lineitem GROUP BY 1",
)
def conditional(spark, sf):
    rules = {"discounted": F.col("l_discount") > 0.05, "bulk": F.col("l_quantity") >= 40, "untaxed": F.col("l_tax") == 0}
    return agg.profile_counts(table(spark, sf, "lineitem"), rules, ["l_returnflag"])


STAT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_statistics",
    "AGG6",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, MIN({c}) AS min_value, MAX({c}) AS max_value, {rmean(c)} AS avg_value FROM lineitem" for c in STAT_COLUMNS),
)
def column_stats(spark, sf):
    return agg.col_stats(table(spark, sf, "lineitem"), STAT_COLUMNS)


@query("rating_frequency", "AGG7", R + " SELECT rating, COUNT(*) AS n FROM reviews GROUP BY 1")
def rating_freq(spark, sf):
    return agg.freq(reviews(spark, sf), "rating")


@query("top_priorities", "AGG8 SRT2", "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
def priorities(spark, sf):
    return agg.top_values(table(spark, sf, "orders"), "o_orderpriority", 5)


@query("orders_by_month", "AGG9", "SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, CAST(MONTH(o_orderdate) AS INTEGER) AS month, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2")
def monthly(spark, sf):
    return agg.monthly_distribution(table(spark, sf, "orders"), "o_orderdate")


@query("order_date_context", "AGG10", "SELECT MIN(o_orderdate) AS min_date, MAX(o_orderdate) AS max_date, COUNT(*) AS total_rows FROM orders")
def context(spark, sf):
    return agg.date_context(table(spark, sf, "orders"), "o_orderdate")


@query("duplicate_line_keys", "AGG11", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def duplicates(spark, sf):
    return agg.dup_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "multi_line_suppliers",
    "AGG12 PRD4",
    S + " SELECT supplier_id, COUNT(*) AS n_lines, STRING_AGG(product_line_id, ', ' ORDER BY product_line_id) AS line_list FROM (SELECT DISTINCT supplier_id, product_line_id FROM sales) GROUP BY 1 HAVING COUNT(*) > 1",
)
def multi_line(spark, sf):
    return agg.conflict_groups(sales(spark, sf), "supplier_id", "product_line_id")


@query("source_shares", "AGG13", "SELECT source, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM documents) * 100 AS pct FROM documents GROUP BY 1")
def shares(spark, sf):
    return agg.with_pct(table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")))


@query(
    "rollup_sales",
    "AGG15",
    S + f" SELECT p AS platform_id, f AS product_line_id, COUNT(*) AS n, {msum('lineproduct_price')} AS revenue FROM (SELECT *, UNNEST([product_line_id, 'all']) AS f FROM (SELECT *, UNNEST([platform_id, 'all']) AS p FROM sales)) GROUP BY 1, 2",
)
def rollup(spark, sf):
    both = agg.with_rollup_all(agg.with_rollup_all(sales(spark, sf), "platform_id"), "product_line_id")
    return both.groupBy("platform_id", "product_line_id").agg(F.count(F.lit(1)).alias("n"), exact_sum("lineproduct_price").alias("revenue"))


@query(
    "product_features",
    "AGG16 POI3",
    S + f""" SELECT product_id, COUNT(*) AS n_sales, COUNT(DISTINCT order_date) AS sales_days, SUM(quantity) AS sum_quantity, SUM(quantity) / COUNT(quantity) AS avg_quantity,
      MIN(quantity) AS min_quantity, MAX(quantity) AS max_quantity, ROUND({rmean('gross_price / quantity')}, 4) AS avg_price, MIN(gross_price / quantity) AS min_price, MAX(gross_price / quantity) AS max_price,
      MAX(gross_price / quantity) - MIN(gross_price / quantity) AS price_range,
      CASE WHEN MAX(gross_price / quantity) > MIN(gross_price / quantity) THEN 100 / (MAX(gross_price / quantity) - MIN(gross_price / quantity)) ELSE 100.0 END AS track_multiplier FROM sales GROUP BY 1""",
)
def features(spark, sf):
    return agg.product_features(order_lines(spark, sf)).withColumn("avg_price", F.round("avg_price", 4))


@query("latest_order_per_customer", "WIN1", "SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def latest(spark, sf):
    return window.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "priority_dedup",
    "WIN2",
    "SELECT * EXCLUDE (source_rank), source_rank FROM (SELECT l_partkey, l_suppkey, l_orderkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS source_rank, l_linenumber, l_extendedprice FROM lineitem) QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY source_rank, l_orderkey, l_linenumber, l_extendedprice) = 1",
)
def priority(spark, sf):
    rank = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", rank.alias("source_rank"), "l_linenumber", "l_extendedprice")
    return window.dedup_by_priority(li, ["l_partkey", "l_suppkey"], "source_rank", ["l_orderkey", "l_linenumber", "l_extendedprice"])


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query(
    "transaction_ids",
    "WIN3",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, FORMAT('{{}}_{{:03d}}', l_orderkey, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)})) AS transaction_id FROM lineitem",
)
def txn_ids(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER)
    return window.make_txn_id(li, "l_orderkey", LINE_ORDER).drop("l_shipdate")


@query(
    "suffixed_duplicate_keys",
    "WIN3",
    f"""SELECT k AS raw_key, CASE WHEN n > 1 THEN k || '_' || s ELSE k END AS transaction_id, l_partkey, l_extendedprice FROM (
      SELECT *, COUNT(*) OVER (PARTITION BY k) AS n, ROW_NUMBER() OVER (PARTITION BY k ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS s FROM (SELECT *, l_orderkey || '_' || l_linenumber AS k FROM lineitem))""",
)
def suffixes(spark, sf):
    key = F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    li = table(spark, sf, "lineitem").select(key.alias("raw_key"), "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    out = window.suffix_duplicates(li, "raw_key", ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"], "transaction_id")
    return out.select("raw_key", "transaction_id", "l_partkey", "l_extendedprice")


@query("global_surrogate_ids", "WIN4", "SELECT o_orderkey, o_orderdate, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS mapping_id FROM orders")
def surrogate(spark, sf):
    return window.surrogate(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query(
    "last_reviews_per_competitor",
    "WIN5",
    R + """, j AS (SELECT review_id, product_id, review_date, p_brand NOT IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5') AS rival FROM reviews JOIN part ON p_partkey = product_id)
      SELECT * FROM j WHERE rival QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY review_date DESC, review_id) <= 30""",
)
def last_n(spark, sf):
    p = products(spark, sf).select("product_id", (~F.col("is_own")).alias("rival"))
    r = reviews(spark, sf).select("review_id", "review_date", "product_id").join(p, "product_id").filter("rival")
    return window.tail_per_group(r, ["product_id"], "review_date", ["review_id"], 30)


@query("first_items_per_line", "WIN6", "SELECT p_type, p_partkey FROM part QUALIFY ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY p_partkey) <= 3")
def first_n(spark, sf):
    return window.head_per_group(table(spark, sf, "part").select("p_type", "p_partkey"), ["p_type"], ["p_partkey"], 3)


@query("group_winner_flag", "WIN7 PRD4", "SELECT p_brand, p_size, p_partkey, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) = 1 AS is_winner FROM part")
def winners(spark, sf):
    return window.winner_flag(table(spark, sf, "part").select("p_brand", "p_size", "p_partkey"), "p_brand", ["p_size", "p_partkey"])


@query("exact_duplicate_lines", "WIN8", "SELECT DISTINCT * FROM lineitem")
def exact_dups(spark, sf):
    """Whole rows: true copies, made here by repeating every seventh row, go; lines that share a key stay."""
    lines = table(spark, sf, "lineitem")
    copies = lines.filter(F.pmod(F.xxhash64(*lines.columns), F.lit(7)) == 0)
    return window.drop_exact_dups(lines.unionByName(copies))


@query("first_row_per_key", "WIN9", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1")
def dedup(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return window.dedup(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


@query("fanout_preserving_dedup", "WIN10 PRD3", S + " SELECT product_id, platform_id, product_line_id, MIN(product_name) AS product_name FROM sales GROUP BY 1, 2, 3")
def fanout_dedup(spark, sf):
    s = sales(spark, sf).select("product_id", "platform_id", "product_line_id", "product_name")
    return window.dedup_fanout(s, ["product_id", "platform_id", "product_line_id"], ["product_name"])


@query("modelable_pairs", "WIN11", "SELECT p_type, p_brand, BOOL_AND(p_size <> 7) AS modelable FROM part GROUP BY 1, 2")
def modelable(spark, sf):
    p = table(spark, sf, "part").select("p_type", "p_brand", (F.col("p_size") != 7).alias("modelable"))
    return window.all_true_per_key(p, ["p_type", "p_brand"], "modelable")


@query("sorted_products", "SRT1", "SELECT p_partkey, p_type, p_retailprice FROM part")
def sorted_products(spark, sf):
    return window.sort(table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice"), ["p_type", F.col("p_retailprice").desc(), "p_partkey"])


@query("largest_orders", "SRT2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def largest(spark, sf):
    return window.head(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"], 20)


@query("union_by_name", "SET1 SRC10", "SELECT p_partkey AS id, p_name AS name, p_size AS size, CAST(NULL AS DOUBLE) AS balance FROM part UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sets.union_all(p, s)


@query("distinct_mappings", "SET2", "SELECT p_partkey AS item, p_type AS line FROM part WHERE p_size < 30 UNION SELECT p_partkey, p_type FROM part WHERE p_size > 10")
def mappings(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_type").alias("line"), "p_size")
    return sets.union_distinct(p.filter("p_size < 30").drop("p_size"), p.filter("p_size > 10").drop("p_size"))


@query("shared_customers", "SET3", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def shared(spark, sf):
    o = table(spark, sf, "orders")
    return sets.intersect_keys(o.filter("o_orderstatus = 'P'").select("o_custkey"), o.filter("o_orderstatus = 'F'").select("o_custkey"))


@query("dropped_customers", "SET4", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
def dropped(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'")
    return sets.except_keys(table(spark, sf, "customer").select("c_custkey"), o.select(F.col("o_custkey").alias("c_custkey")))


@query("product_master", "SET5", "SELECT p_partkey, CASE WHEN p_type < 'M' THEN p_size END AS size, CASE WHEN p_type >= 'M' THEN p_brand END AS brand, p_type AS product_line_id FROM part")
def master(spark, sf):
    p = table(spark, sf, "part")
    lines = [r[0] for r in p.select("p_type").distinct().orderBy("p_type").collect()]  # one entry for each product line
    # lines have different profile columns
    pick = lambda line: p.filter(F.col("p_type") == line).select("p_partkey", *([F.col("p_size").alias("size")] if line < "M" else [F.col("p_brand").alias("brand")]))
    return sets.product_master({line: pick(line) for line in lines})


# Two snapshots of item prices: mean line price before and from 1999 on.
SNAP_SQL = """b AS (SELECT l_partkey, AVG(l_discount) AS v FROM lineitem WHERE l_shipdate < '1998-06-01' GROUP BY 1),
a AS (SELECT l_partkey, AVG(l_discount) AS v FROM lineitem WHERE l_shipdate >= '1998-06-01' GROUP BY 1)"""


def _snapshots(spark, sf):
    li = table(spark, sf, "lineitem")
    cut = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    mean = lambda d: d.groupBy("l_partkey").agg(F.round(F.avg("l_discount"), 6).alias("v")).withColumn("sig", F.col("v") > 0.05)
    return mean(li.filter(cut)), mean(li.filter(~cut))


@query(
    "snapshot_difference",
    "SET6",
    f"""WITH {SNAP_SQL} SELECT l_partkey, ROUND(b.v, 6) AS value_before, ROUND(a.v, 6) AS value_after, ROUND(b.v, 6) > 0.05 AS sig_before, ROUND(a.v, 6) > 0.05 AS sig_after,
      CASE WHEN b.v IS NULL THEN 'new' WHEN a.v IS NULL THEN 'dropped' WHEN ABS(ROUND(a.v, 6) - ROUND(b.v, 6)) > 1e-6 THEN 'drifted' ELSE 'unchanged' END AS change,
      COALESCE((ROUND(b.v, 6) > 0.05) <> (ROUND(a.v, 6) > 0.05), FALSE) AS significance_flip FROM b FULL JOIN a USING (l_partkey)""",
)
def difference(spark, sf):
    return sets.snapshot_diff(*_snapshots(spark, sf), ["l_partkey"], "v", "sig")


@query("snapshot_category_balance", "SET6", f"WITH {SNAP_SQL}, x AS (SELECT ROUND(v, 6) > 0.05 AS sig, COUNT(*) AS n FROM b GROUP BY 1), y AS (SELECT ROUND(v, 6) > 0.05 AS sig, COUNT(*) AS n FROM a GROUP BY 1) SELECT sig, COALESCE(x.n, 0) AS n_before, COALESCE(y.n, 0) AS n_after FROM x FULL JOIN y USING (sig)")
def balance(spark, sf):
    return sets.category_balance(*_snapshots(spark, sf), "sig")


@query("largest_drift", "SRT4", f"WITH {SNAP_SQL} SELECT l_partkey, ROUND(b.v, 6) AS value_before, ROUND(a.v, 6) AS value_after, ROUND(a.v, 6) - ROUND(b.v, 6) AS delta FROM a JOIN b USING (l_partkey) ORDER BY ABS(ROUND(a.v, 6) - ROUND(b.v, 6)) DESC, l_partkey LIMIT 15")
def drift(spark, sf):
    return window.top_drift(*_snapshots(spark, sf), ["l_partkey"], "v", 15)
