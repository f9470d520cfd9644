"""Registered projection, filter and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.operators import clean
from martloom.plans.commerce import PLATFORM_SQL, SALES_SQL, REVIEWS_SQL, order_lines, products, reviews, sales, status_of, table
from martloom.plans.registry import query

S = "WITH " + SALES_SQL
R = "WITH " + REVIEWS_SQL


@query("canonical_fallback_columns", "PRJ1", "SELECT o_orderkey, o_orderdate AS payment_time, o_totalprice AS lineproduct_price FROM orders")
def fallback(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed({"o_orderdate": "order_created_at", "o_totalprice": "total_amount"})
    o = clean.first_present(o, "payment_time", ["order_date", "order_created_at", "purchase_date"])
    o = clean.first_present(o, "lineproduct_price", ["line_total", "total_amount", "item_price"])
    return o.select("o_orderkey", "payment_time", "lineproduct_price")


@query(
    "lineage_columns",
    "PRJ2",
    "SELECT o_orderkey, 'amz' AS platform_id, CAST(NULL AS VARCHAR) AS product_line_id, 'v1' AS standardization_version, 'standardized' AS etl_phase FROM orders",
)
def lineage(spark, sf):
    return clean.with_lineage(table(spark, sf, "orders").select("o_orderkey"), "amz", "v1", "standardized").drop("standardization_timestamp")


MONEY_SQL = """SELECT l_orderkey, l_linenumber, l_quantity AS quantity, CASE WHEN l_linenumber % 4 <> 0 THEN l_extendedprice / l_quantity END AS unit_price,
   CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice * (1 - l_discount) END AS discounted_price FROM lineitem"""


@query(
    "derived_money",
    "PRJ3",
    f"""SELECT l_orderkey, l_linenumber, quantity, CAST(ROUND(CAST(u AS DECIMAL(28,6)), 2) AS DOUBLE) AS unit_price,
      CAST(ROUND(CAST(COALESCE(discounted_price, quantity * u) AS DECIMAL(28,6)), 2) AS DOUBLE) AS line_total,
      CAST(ROUND(CAST(GREATEST(COALESCE(quantity * u - discounted_price, 0.0), 0.0) AS DECIMAL(28,6)), 2) AS DOUBLE) AS discount
      FROM (SELECT *, COALESCE(unit_price, discounted_price / quantity) AS u FROM ({MONEY_SQL}))""",
)
def money(spark, sf):
    li = table(spark, sf, "lineitem")
    raw = li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_linenumber") % 4 != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted_price"),
    )
    return clean.derive_money(raw).drop("discounted_price")


@query(
    "marketplace_margin",
    "PRJ4 FN22",
    """SELECT l_orderkey, l_linenumber, g AS gross_revenue, g * 0.9 AS net_revenue, g * 0.1 AS marketplace_fee, g * 0.9 - g * 0.1 AS net_profit,
      ROUND(CASE WHEN p > 0 THEN (p - u * 0.7) / p * 100 ELSE 0.0 END, 6) AS profit_margin, CASE WHEN fee > 0 THEN 'SELLER_FULFILLED' ELSE 'FREE_SHIPPING' END AS fulfilment_class
      FROM (SELECT l_orderkey, l_linenumber, l_quantity * (l_extendedprice * (1 - l_discount)) AS g, l_extendedprice * (1 - l_discount) AS p, l_extendedprice AS u, l_tax AS fee FROM lineitem)""",
)
def margin(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("transaction_price"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_tax").alias("shipping_fee"),
    )
    return clean.derive_margin(li).drop("quantity", "transaction_price", "unit_price", "shipping_fee").withColumn("profit_margin", F.round("profit_margin", 6))


@query("front_columns", "PRJ5 PRJ6", "SELECT p_brand, p_type, p_partkey, p_name FROM part")
def front_columns(spark, sf):
    p = clean.front(table(spark, sf, "part"), ["p_brand", "p_type", "not_there"])
    return clean.select_any(p, ["p_brand", "p_type", "p_partkey", "p_name", "absent"])


MESSY_SQL = """messy AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN ' NA' ELSE '  ' || o_orderpriority || ' ' END AS tag,
   CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE ' Customer ' || o_custkey || ' ' END AS who FROM orders)"""


def _messy(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 7 == 0, None).when(k % 7 == 1, "   ").when(k % 7 == 2, " NA").otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("tag"),
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string"), F.lit(" "))).alias("who"),
    )


@query("trimmed_text", "PRJ7", f"WITH {MESSY_SQL} SELECT o_orderkey, TRIM(tag) AS tag, TRIM(who) AS who FROM messy")
def trimmed(spark, sf):
    return clean.trim_all(_messy(spark, sf))


@query("blank_to_null", "PRJ8", f"WITH {MESSY_SQL} SELECT o_orderkey, CASE WHEN TRIM(tag) NOT IN ('', 'NA') THEN tag END AS tag, NULLIF(who, '') AS who FROM messy")
def blanks(spark, sf):
    return clean.blank_to_null(_messy(spark, sf))


@query(
    "safe_numbers",
    "PRJ9",
    """SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS plain, TRY_CAST(REGEXP_REPLACE(o_orderpriority, '[^0-9.]', '', 'g') AS DOUBLE) AS stripped,
     TRY_CAST(REGEXP_REPLACE('TWD ' || CAST(CAST(o_custkey AS INTEGER) AS VARCHAR) || '.5 net', '[^0-9.]', '', 'g') AS DOUBLE) AS price FROM orders""",
)
def numbers(spark, sf):
    price = F.concat(F.lit("TWD "), F.col("o_custkey").cast("string"), F.lit(".5 net"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        clean.to_number(F.col("o_orderpriority")).alias("plain"),
        clean.to_number(F.col("o_orderpriority"), strip=True).alias("stripped"),
        clean.to_number(price, strip=True).alias("price"),
    )


@query(
    "safe_flags",
    "PRJ10",
    """SELECT doc_id, COALESCE(CASE (doc_id % 4) WHEN 0 THEN TRUE WHEN 1 THEN FALSE END, TRUE) AS active, COALESCE(toxic = 1, FALSE) AS toxic
     FROM documents LEFT JOIN labels USING (doc_id)""",
)
def flags(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    raw = F.element_at(F.array(F.lit("true"), F.lit("false"), F.lit("maybe"), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return d.select("doc_id", clean.to_flag(raw, default=True).alias("active"), clean.to_flag(F.col("toxic").cast("string")).alias("toxic"))


@query("nonblank_keys", "FLT1", f"WITH {MESSY_SQL} SELECT * FROM messy WHERE LENGTH(TRIM(tag)) > 0 AND LENGTH(TRIM(who)) > 0")
def nonblank(spark, sf):
    return clean.require_nonblank(_messy(spark, sf), ["tag", "who"])


@query(
    "invalid_to_null",
    "FLT2",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
      CASE WHEN REGEXP_MATCHES(mail, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') THEN mail END AS mail
      FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'c' || c_custkey || '@example.com' ELSE 'c' || c_custkey || '@example' END AS mail FROM customer)""",
)
def invalid(spark, sf):
    k = F.col("c_custkey")
    name = F.concat(F.lit("c"), k.cast("string"))
    mail = F.when(k % 3 == 0, F.col("c_name")).when(k % 3 == 1, F.concat(name, F.lit("@example.com"))).otherwise(F.concat(name, F.lit("@example")))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), mail.alias("mail"))
    return clean.null_if(c, {"balance": F.col("balance") < 0, "mail": ~text.valid_email(F.col("mail"))})


ITEM_SQL = "CASE WHEN {k} % 4 = 0 THEN 'UNKNOWN_PRODUCT' WHEN {k} % 4 = 1 THEN '' ELSE 'P' || {k} END"


@query("item_code_filter", "FLT3", "SELECT p_partkey, code FROM (SELECT p_partkey, 'B' || LPAD(CAST(p_partkey AS VARCHAR), 3 + p_size % 8, '0') AS code FROM part) WHERE REGEXP_MATCHES(code, '^[A-Z0-9]{10}$')")
def item_codes(spark, sf):
    code = F.concat(F.lit("B"), F.expr("lpad(cast(p_partkey as string), 3 + p_size % 8, '0')"))
    return clean.keep_matching(table(spark, sf, "part").select("p_partkey", code.alias("code")), "code", clean.ASIN)


@query("test_orders_dropped", "FLT4", "SELECT o_orderkey FROM (SELECT o_orderkey, CASE o_orderkey % 9 WHEN 3 THEN 'test-' WHEN 4 THEN 'X-Demo' ELSE 'A' END || o_orderkey AS number FROM orders) WHERE NOT REGEXP_MATCHES(UPPER(number), 'TEST|DEMO')")
def test_orders(spark, sf):
    k = F.col("o_orderkey")
    number = F.concat(F.when(k % 9 == 3, "test-").when(k % 9 == 4, "X-Demo").otherwise("A"), k.cast("string"))
    return clean.drop_test_orders(table(spark, sf, "orders").select("o_orderkey", number.alias("order_number"))).select("o_orderkey")


@query("active_lines_only", "FLT5", S + " SELECT product_line_id, COUNT(*) AS n FROM sales WHERE product_line_id IN (SELECT p_type FROM part GROUP BY p_type HAVING AVG(p_size) > 25.4) GROUP BY ALL")
def active_lines(spark, sf):
    lines = products(spark, sf).groupBy("product_line_id").agg((F.avg("size") > 25.4).alias("is_active"))
    return clean.keep_active(sales(spark, sf), lines).groupBy("product_line_id").agg(F.count(F.lit(1)).alias("n"))


@query("sentinel_lines_dropped", "FLT6", "SELECT * FROM (SELECT p_partkey, CASE p_size % 5 WHEN 1 THEN 'unclassified' WHEN 2 THEN '  ' ELSE p_type END AS product_line_id FROM part) WHERE TRIM(product_line_id) NOT IN ('', 'unclassified', 'UNKNOWN')")
def sentinels(spark, sf):
    line = F.when(F.col("p_size") % 5 == 1, "unclassified").when(F.col("p_size") % 5 == 2, "  ").otherwise(F.col("p_type"))
    return clean.drop_sentinels(table(spark, sf, "part").select("p_partkey", line.alias("product_line_id")))


@query("error_results", "FLT7 REV5", "SELECT event_type, COUNT(*) AS n FROM (SELECT event_type, CASE event_id % 5 WHEN 0 THEN 'call: Connection_error 12' WHEN 1 THEN 'got timeout' ELSE event_type END AS result FROM events) WHERE result LIKE '%Connection_error%' OR result LIKE '%timeout%' OR result LIKE '%rate_limit%' GROUP BY ALL")
def errors(spark, sf):
    k = F.col("event_id") % 5
    result = F.when(k == 0, "call: Connection_error 12").when(k == 1, "got timeout").otherwise(F.col("event_type"))
    e = table(spark, sf, "events").select("event_type", result.alias("result"))
    return clean.error_rows(e, "result").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("shipped_orders", "FLT8", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'F')")
def shipped_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", status_of(F.col("o_orderstatus")).alias("order_status"))
    return clean.shipped(o).select("o_orderkey")


BACKFILL_SQL = f"""raw AS (SELECT l_orderkey, l_linenumber, {ITEM_SQL.format(k='l_partkey')} AS product_id,
   CASE WHEN l_suppkey % 2 = 0 THEN 'B' || LPAD(CAST(l_partkey AS VARCHAR), 9, '0') ELSE 'sku-' || l_partkey END AS sku FROM lineitem)"""


def _backfill(spark, sf):
    k = F.col("l_partkey")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(k % 4 == 0, "UNKNOWN_PRODUCT").when(k % 4 == 1, "").otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("product_id"),
        F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("B"), F.lpad(k.cast("string"), 9, "0"))).otherwise(F.concat(F.lit("sku-"), k.cast("string"))).alias("sku"),
    )
    return clean.backfill_id(li, "product_id", "sku", "lineitem", "l_orderkey")


@query("item_id_backfill", "FLT9", f"WITH {BACKFILL_SQL} SELECT l_orderkey, l_linenumber, sku, CASE WHEN product_id IN ('UNKNOWN_PRODUCT', '') AND sku LIKE 'B%' THEN sku ELSE product_id END AS product_id FROM raw")
def backfill(spark, sf):
    return _backfill(spark, sf)[0]


@query("item_id_backfill_audit", "FLT9", f"WITH {BACKFILL_SQL} SELECT 'lineitem' AS source_table, CAST(l_orderkey AS VARCHAR) AS source_row_id, 'sku_used_as_item_id' AS reason FROM raw WHERE product_id IN ('UNKNOWN_PRODUCT', '') AND sku LIKE 'B%'")
def backfill_audit(spark, sf):
    return _backfill(spark, sf)[1]


@query(
    "mixed_date_texts",
    "FN1",
    """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 7 THEN NULL WHEN 2 THEN STRFTIME(o_orderdate + INTERVAL '13 hours 5 minutes 9 seconds', '%Y-%m-%d %H:%M:%S')
       WHEN 6 THEN CASE WHEN DAY(o_orderdate) <= 12 THEN STRFTIME(o_orderdate, '%Y-%d-%m 00:00:00') ELSE STRFTIME(o_orderdate, '%Y-%m-%d 00:00:00') END
       ELSE STRFTIME(o_orderdate, '%Y-%m-%d 00:00:00') END AS parsed FROM orders""",
)
def mixed_dates(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 8
    serial = (F.datediff(d, F.lit("1970-01-01").cast("date")) + 25569).cast("string")
    raw = (
        F.when(k == 0, serial)
        .when(k == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T13:05:09Z")))
        .when(k == 3, F.date_format(d, "yyyy/MM/dd"))
        .when(k == 4, F.date_format(d, "M/d/yyyy"))
        .when(k == 5, F.date_format(d, "yyyy-MM-dd 00:00:00.000"))
        .when(k == 6, F.date_format(d, "dd/MM/yyyy"))
        .otherwise("not a date")
    )
    o = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return o.select("o_orderkey", F.date_format(dates.parse_mixed_ts(F.col("raw")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "iso_compact_month_dates",
    "FN2 FN3 FN5",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS iso, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS compact,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN DATE_TRUNC('month', o_orderdate) ELSE o_orderdate END AS DATE) AS month FROM orders""",
)
def simple_dates(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    iso = F.when(k % 5 == 0, "2024-13-45").otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00+08:00")))
    compact = F.when(k % 7 == 0, "20241399").otherwise(F.date_format(d, "yyyyMMddHHmm"))
    month = F.when(k % 2 == 0, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", dates.parse_iso_date(iso).alias("iso"), dates.parse_compact(compact).alias("compact"), dates.month_to_date(month).alias("month"))


@query("localised_review_dates", "FN4", R + " SELECT review_id, CASE WHEN review_id % 6 <> 5 THEN review_date END AS review_date FROM reviews")
def localised(spark, sf):
    d, k = F.col("review_date"), F.col("review_id") % 6
    said = (
        F.when(k == 5, "Reviewed long ago")
        .when(k < 3, F.concat(F.lit("Reviewed in the United States on "), F.date_format(d, "MMMM d, yyyy")))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    return reviews(spark, sf).select("review_id", said.alias("said")).select("review_id", dates.review_date(F.col("said")).alias("review_date"))


@query(
    "order_date_parts",
    "FN6",
    """SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS order_year, CAST(MONTH(o_orderdate) AS INTEGER) AS order_month, CAST(QUARTER(o_orderdate) AS INTEGER) AS order_quarter,
       CAST(DAY(o_orderdate) AS INTEGER) AS order_day, DAYNAME(o_orderdate) AS order_weekday FROM orders""",
)
def parts(spark, sf):
    return dates.date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "calendar_dummies",
    "FN7",
    "SELECT o_orderkey, CAST(YEAR(o_orderdate) AS DOUBLE) AS year, CAST(DAY(o_orderdate) AS DOUBLE) AS day, "
    + ", ".join(f"CAST(MONTH(o_orderdate) = {m} AS INTEGER)::DOUBLE AS month_{m}" for m in range(1, 13))
    + ", "
    + ", ".join(f"CAST(ISODOW(o_orderdate) = {i} AS INTEGER)::DOUBLE AS {d}" for i, d in enumerate(dates.WEEKDAYS, 1))
    + " FROM orders",
)
def dummies(spark, sf):
    return dates.calendar_dummies(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "customer_month_span",
    "FN8",
    """SELECT o_custkey, CAST((YEAR(b) * 12 + MONTH(b)) - (YEAR(a) * 12 + MONTH(a)) + 1 AS INTEGER) AS months FROM (
      SELECT o_custkey, MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders GROUP BY o_custkey)""",
)
def span(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return o.select("o_custkey", dates.months_span(F.col("a"), F.col("b")).alias("months"))


@query(
    "order_period_bounds",
    "FN9",
    """SELECT y AS year, m AS month, CAST(s AS DATE) AS date_start, CAST(e AS DATE) AS date_end, CAST(CAST(e AS DATE) - CAST(s AS DATE) + 1 AS INTEGER) AS period_days, n FROM (
      SELECT y, m, n, MAKE_DATE(y, COALESCE(m, 1), 1) AS s, CASE WHEN m IS NULL THEN MAKE_DATE(y, 12, 31) ELSE LAST_DAY(MAKE_DATE(y, m, 1)) END AS e
      FROM (SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS y, CAST(MONTH(o_orderdate) AS INTEGER) AS m, COUNT(*) AS n FROM orders GROUP BY ROLLUP (1, 2)) WHERE y IS NOT NULL)""",
)
def bounds(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return dates.period_bounds(o.rollup("year", "month").agg(F.count(F.lit(1)).alias("n")).filter("year is not null"), "year", "month")


@query(
    "normalised_text",
    "FN10 FN11",
    """SELECT c_custkey, LOWER(TRIM(' ' || c_name || ' ')) AS low, UPPER(TRIM(c_mktsegment)) AS up, REGEXP_REPLACE('09 ' || c_custkey || ' 12', '\\s+', '', 'g') AS phone,
       CASE WHEN c_custkey % 4 <> 0 THEN 'shop' || c_nationkey || '.example.com' END AS domain, c_custkey % 4 <> 0 AS mail_ok FROM customer""",
)
def normal(spark, sf):
    k = F.col("c_custkey")
    mail = F.when(k % 4 == 0, "no mail").otherwise(F.concat(F.lit("U"), k.cast("string"), F.lit("@Shop"), F.col("c_nationkey").cast("string"), F.lit(".example.com")))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.norm_text(F.concat(F.lit(" "), "c_name", F.lit(" ")), "lower").alias("low"),
        text.norm_text(F.col("c_mktsegment"), "upper").alias("up"),
        text.norm_text(F.concat(F.lit("09 "), k.cast("string"), F.lit(" 12")), "squash").alias("phone"),
        text.email_domain(mail).alias("domain"),
        text.valid_email(mail).alias("mail_ok"),
    )


LOCAL_STATES = ["待處理", "處理中", "已出貨", "已送達", "已完成", "已取消", "已退款", "退貨", " Returned "]
LOCAL_CODES = ["pending", "processing", "shipped", "delivered", "delivered", "cancelled", "refunded", "refunded", "returned"]


def _sql_list(items):
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


@query(
    "status_and_payment_codes",
    "FN12",
    f"""SELECT o_orderkey, {_sql_list(LOCAL_STATES)}[CAST(o_orderkey % 9 + 1 AS INTEGER)] AS order_status_original, {_sql_list(LOCAL_CODES)}[CAST(o_orderkey % 9 + 1 AS INTEGER)] AS order_status,
      ['credit_card','bank_transfer','cash_on_delivery','paypal','other'][CAST(o_custkey % 5 + 1 AS INTEGER)] AS payment_method FROM orders""",
)
def codes(spark, sf):
    pick = lambda items, k: F.element_at(F.array(*[F.lit(i) for i in items]), (k + 1).cast("int"))
    state = pick(LOCAL_STATES, F.col("o_orderkey") % 9)
    pay = pick(["信用卡", "轉帳", "貨到付款", "PayPal", "voucher"], F.col("o_custkey") % 5)
    return table(spark, sf, "orders").select(
        "o_orderkey", state.alias("order_status_original"), text.order_status(state).alias("order_status"), text.payment_method(pay).alias("payment_method")
    )


ADDRESS_SQL = """addr AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 4 = 0 THEN ' Z' || c_custkey || ' ' END AS ship_postal_code,
  CASE WHEN o_orderkey % 4 <= 1 THEN c_name ELSE ' ' END AS ship_city, r_name AS ship_state, n_name AS ship_country,
  CASE WHEN o_orderkey % 4 = 2 THEN 'B' || c_custkey END AS buyer_identification_number
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


@query(
    "buyer_identity_key",
    "FN13",
    f"""WITH {ADDRESS_SQL} SELECT order_id, CASE order_id % 4
      WHEN 0 THEN 'postal::' || LOWER(TRIM(ship_postal_code)) || '::' || LOWER(ship_city) || '::' || LOWER(ship_state) || '::' || LOWER(ship_country)
      WHEN 1 THEN 'geo::' || LOWER(ship_city) || '::' || LOWER(ship_state) || '::' || LOWER(ship_country)
      WHEN 2 THEN 'bid::' || LOWER(buyer_identification_number) ELSE 'order::' || order_id END AS customer_identity_key FROM addr""",
)
def identity(spark, sf):
    k = F.col("o_orderkey") % 4
    cust = F.col("c_custkey").cast("string")
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    a = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.when(k == 0, F.concat(F.lit(" Z"), cust, F.lit(" "))).alias("ship_postal_code"),
            F.when(k <= 1, F.col("c_name")).otherwise(" ").alias("ship_city"),
            F.col("r_name").alias("ship_state"),
            F.col("n_name").alias("ship_country"),
            F.when(k == 2, F.concat(F.lit("B"), cust)).alias("buyer_identification_number"),
        )
    )
    return a.select("order_id", text.identity_key(a).alias("customer_identity_key"))


@query(
    "canonical_names",
    "FN14 FN19",
    """SELECT p_partkey, LOWER(REGEXP_REPLACE(TRIM(p_brand || ' / ' || p_name || '-X'), '[^\\p{L}\\p{N}]+', '_', 'g')) AS canon, LOWER(REPLACE(p_name, ' ', '_')) AS pattern FROM part""",
)
def canonical(spark, sf):
    name = F.concat("p_brand", F.lit(" / "), "p_name", F.lit("-X"))
    return table(spark, sf, "part").select("p_partkey", text.canon_name(name).alias("canon"), text.predictor_pattern(F.col("p_name")).alias("pattern"))


RAW_SCALES = ["2", "2尺度", "5", " 5尺度 ", "", "3"]
SCALE_SQL = f"SELECT p_partkey, {_sql_list(['2尺度', '2尺度', '5尺度', '5尺度', '5尺度', '3'])}[p_size % 6 + 1] AS scale FROM part"


def _raw_scales(spark, sf):
    raw = F.element_at(F.array(*[F.lit(s) for s in RAW_SCALES]), F.col("p_size") % 6 + 1)
    return table(spark, sf, "part").select("p_partkey", raw.alias("scale"))


@query("topic_scales", "FN15", SCALE_SQL)
def scales(spark, sf):
    return _raw_scales(spark, sf).withColumn("scale", text.norm_scale(F.col("scale")))


@query("unknown_topic_scales", "FN15", f"SELECT scale, COUNT(*) AS n FROM ({SCALE_SQL}) WHERE scale = '3' GROUP BY ALL")
def bad_scales(spark, sf):
    return text.unknown_scales(_raw_scales(spark, sf), "scale")


@query("cleaned_text", "FN16", "SELECT doc_id, NULLIF(TRIM(REGEXP_REPLACE(text, '[\\x00-\\x1F\\x7F]', '', 'g')), '') AS text FROM documents")
def cleaned(spark, sf):
    return text.clean_text(table(spark, sf, "documents").select("doc_id", "text"))


SUSPECT_SQL = "[\\x00-\\x1F\\x{FFFD}\\x{2500}-\\x{257F}]|[\\x{0400}-\\x{04FF}][A-Za-z]|[A-Za-z][\\x{0400}-\\x{04FF}]"


@query(
    "encoding_audit",
    "FN16",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) FILTER (REGEXP_MATCHES({c}, '{SUSPECT_SQL}')) AS n_suspect, MIN({c}) FILTER (REGEXP_MATCHES({c}, '{SUSPECT_SQL}')) AS sample_value FROM documents" for c in ("text", "lang", "source")),
)
def encoding(spark, sf):
    return text.mojibake_audit(table(spark, sf, "documents"))


@query(
    "predictor_terms",
    "FN17",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'brand' WHEN p_size % 3 = 1 THEN 'Type' END AS source_variable,
       CASE WHEN p_size % 3 <= 1 THEN 'dummy' WHEN p_size % 2 = 0 THEN 'binary' ELSE 'numerical' END AS data_type FROM part""",
)
def terms(spark, sf):
    k = F.col("p_size")
    term = F.when(k % 3 == 0, F.concat(F.lit("brand_"), "p_brand")).when(k % 3 == 1, F.concat(F.lit("Type_"), "p_type")).otherwise("price")
    return table(spark, sf, "part").select("p_partkey", text.source_variable(term).alias("source_variable"), text.data_type(term, k % 2 == 0).alias("data_type"))


@query(
    "review_quality_tiers",
    "FN20 AGG18",
    R + """ SELECT review_id, CASE WHEN rating IS NOT NULL AND review_date IS NOT NULL AND review_text IS NOT NULL THEN 100 WHEN rating IS NOT NULL AND review_date IS NOT NULL THEN 85
      WHEN rating IS NOT NULL THEN 70 ELSE 50 END AS final_quality_score, ROUND((3 + CAST(rating IS NOT NULL AS INT) + CAST(review_date IS NOT NULL AS INT) + CAST(review_text IS NOT NULL AS INT)) / 6.0, 6) AS completeness_score,
      text_length FROM (SELECT review_id, CASE WHEN review_id % 5 > 0 THEN rating END AS rating, CASE WHEN review_id % 3 > 0 THEN review_date END AS review_date,
      CASE WHEN quality = 1 THEN review_body END AS review_text, CAST(LENGTH(review_body) AS INTEGER) AS text_length FROM reviews LEFT JOIN labels ON doc_id = review_id)""",
)
def tiers(spark, sf):
    from martloom.operators.aggregate import completeness

    k = F.col("review_id")
    r = reviews(spark, sf).join(table(spark, sf, "labels"), k == F.col("doc_id"), "left").select(
        "review_id", "product_id", "platform_id", F.lit("line").alias("product_line_id"),
        F.when(k % 5 > 0, F.col("rating")).alias("rating"), F.when(k % 3 > 0, F.col("review_date")).alias("review_date"),
        F.when(F.col("quality") == 1, F.col("review_body")).alias("review_text"), F.length("review_body").alias("text_length"),
    )
    cols = ["platform_id", "product_line_id", "product_id", "review_date", "rating", "review_text"]
    return completeness(text.quality_tier(r), cols).select("review_id", "final_quality_score", F.round("completeness_score", 6).alias("completeness_score"), "text_length")


@query("composite_keys", "FN23", "SELECT COUNT(DISTINCT COALESCE(CAST(l_orderkey AS VARCHAR), '') || '||' || COALESCE(CAST(l_linenumber AS VARCHAR), '')) AS keys, COUNT(*) AS n FROM lineitem")
def keys(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count_distinct(text.composite_key(["l_orderkey", "l_linenumber"])).alias("keys"), F.count(F.lit(1)).alias("n"))


@query("json_leftovers", "FN24", """SELECT event_id, '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS props_json, '["' || event_type || '","x"]' AS tags_json FROM events""")
def leftovers(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "k int").alias("props"), F.array("event_type", F.lit("x")).alias("tags"))
    return text.jsonify(e)


@query(
    "line_fingerprints",
    "FN21",
    """SELECT p_type, SHA256(COUNT(*) || '|' || SUM(('0x' || h[1:8])::BIGINT) || '|' || SUM(('0x' || h[9:16])::BIGINT) || '|' || SUM(('0x' || h[17:24])::BIGINT) || '|' || SUM(('0x' || h[25:32])::BIGINT)) AS fingerprint
       FROM (SELECT p_type, SHA256('{"p_name":"' || p_name || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}') AS h FROM part) GROUP BY p_type""",
)
def fingerprints(spark, sf):
    return text.fingerprint(table(spark, sf, "part"), ["p_type"], ["p_partkey", "p_name", "p_size"])
