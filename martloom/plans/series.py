"""Registered reshape, geography, macro and Poisson queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import labels
from martloom.functions.dates import WEEKDAYS, calendar_dummies
from martloom.operators import aliasing, geo, macro, poisson, reshape
from martloom.operators.aggregate import daily_sales, summary_by_hierarchy
from martloom.operators.window import top_significant
from martloom.plans.commerce import BINARY_TOPICS, RATINGS_SQL, SALES_SQL, TOPICS, as_of, msum, order_lines, products, ratings_long, sales, table
from martloom.plans.newton import newton_sql
from martloom.plans.registry import query
from martloom.sources.documents import split_orders

S = "WITH " + SALES_SQL


# ---- nested, wide and long -------------------------------------------------------------------

DOC_SQL = """doc AS (SELECT o_orderkey, o_orderpriority, o_totalprice, UNNEST(GENERATE_SERIES(1, CAST(o_orderkey % 4 AS INTEGER))) AS i FROM orders)"""


def _documents(spark, sf):
    i = F.when(F.col("o_orderkey") % 4 > 0, F.sequence(F.lit(1), (F.col("o_orderkey") % 4).cast("int"))).otherwise(F.array().cast("array<int>"))
    item = lambda k: F.struct((F.col("o_custkey") + k).alias("sku"), k.alias("quantity"), (F.col("o_totalprice") / k).alias("price"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.array("o_orderpriority", "o_orderstatus").alias("tags"), F.transform(i, item).alias("line_items")
    )


@query("order_document_headers", "SRC9 FN24", """SELECT o_orderkey AS order_id, '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS tags_json FROM orders""")
def headers(spark, sf):
    return split_orders(_documents(spark, sf))[0]


@query(
    "order_document_items",
    "SRC9 RSH1",
    """SELECT order_id, i AS item_seq, o_custkey + i AS sku, i AS quantity, price, order_id || '_' || LPAD(CAST(i AS VARCHAR), 3, '0') AS item_id FROM (
      SELECT o_orderkey AS order_id, o_custkey, CAST(i AS INTEGER) AS i, o_totalprice / i AS price FROM (SELECT *, UNNEST(GENERATE_SERIES(1, CAST(o_orderkey % 4 AS INTEGER))) AS i FROM orders))""",
)
def items(spark, sf):
    return split_orders(_documents(spark, sf))[1]


@query("ratings_long_form", "RSH2", "WITH " + RATINGS_SQL + " SELECT product_line_id, review_id, topic FROM ratings")
def long_form(spark, sf):
    r = ratings_long(spark, sf).select("product_line_id", "review_id").distinct()
    topics = ratings_long(spark, sf).select("product_line_id", "topic").distinct()
    return reshape.reviews_to_long(r, topics)


@query("column_unpivot", "RSH2", "SELECT l_orderkey, l_linenumber, metric, SUM(value) AS value FROM (SELECT l_orderkey, l_linenumber, UNNEST(['l_quantity','l_tax']) AS metric, UNNEST([l_quantity, ROUND(l_tax * 100)]) AS value FROM lineitem) GROUP BY 1, 2, 3")
def unpivot(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_tax", F.round(F.col("l_tax") * 100))
    return reshape.wide_to_long(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"], "metric", "value").groupBy("l_orderkey", "l_linenumber", "metric").agg(F.sum("value").alias("value"))


PIVOT_SQL = ", ".join(f"AVG(rating) FILTER (topic = '{t}') AS {t}" for t in TOPICS)


@query("item_ratings_wide", "RSH3 REV6 JN9", "WITH " + RATINGS_SQL + f" SELECT product_line_id, product_id, {PIVOT_SQL} FROM ratings GROUP BY 1, 2")
def wide(spark, sf):
    return reshape.ratings_wide(ratings_long(spark, sf), ["product_line_id", "product_id"], TOPICS)


@query(
    "binarised_topic_means",
    "RSH4",
    "WITH " + RATINGS_SQL + " SELECT product_line_id, topic, COUNT(rating) AS n, ROUND(AVG(CASE WHEN topic = 'safety' THEN CAST(rating > 0 AS INTEGER)::DOUBLE ELSE rating END), 6) AS rating FROM ratings GROUP BY 1, 2",
)
def binarised(spark, sf):
    b = reshape.binarise(ratings_long(spark, sf), BINARY_TOPICS)
    return b.groupBy("product_line_id", "topic").agg(F.count("rating").alias("n"), F.round(F.avg("rating"), 6).alias("rating"))


@query(
    "one_hot_indicators",
    "RSH5",
    """SELECT p_partkey, parent || '::' || level AS predictor, 1.0::DOUBLE AS x FROM (SELECT p_partkey, UNNEST(['p_type','p_brand']) AS parent, UNNEST([p_type, NULLIF(p_brand, 'Brand#9')]) AS level FROM part) WHERE level IS NOT NULL""",
)
def indicators(spark, sf):
    p = table(spark, sf, "part").withColumn("p_brand", F.when(F.col("p_brand") == "Brand#9", " ").otherwise(F.col("p_brand")))
    return reshape.one_hot(p, ["p_partkey"], ["p_type", "p_brand", "p_name"], exclude=("p_name",))


GRID_SQL = """days AS (SELECT UNNEST(GENERATE_SERIES(a, b, INTERVAL 1 DAY))::DATE AS order_date FROM (SELECT MIN(order_date) AS a, MAX(order_date) AS b FROM sales)),
grid AS (SELECT g.*, order_date FROM (SELECT DISTINCT platform_id, product_line_id FROM sales) g CROSS JOIN days),
daily AS (SELECT platform_id, product_line_id, order_date, SUM(quantity) AS sales, COUNT(*) AS n FROM sales GROUP BY 1, 2, 3),
series AS (SELECT grid.*, COALESCE(sales, 0.0) AS sales, CASE WHEN n IS NULL THEN 'FILLED' ELSE 'REAL' END AS data_source FROM grid LEFT JOIN daily USING (platform_id, product_line_id, order_date))"""


def _line_series(spark, sf):
    daily = sales(spark, sf).groupBy("platform_id", "product_line_id", "order_date").agg(F.sum("quantity").alias("sales"))
    return reshape.complete_series(daily, "order_date", ["platform_id", "product_line_id"], ["sales"])


@query("dense_line_series", "RSH6", S + f", {GRID_SQL} SELECT * FROM series")
def line_series(spark, sf):
    return _line_series(spark, sf)


@query(
    "dense_item_series_coverage",
    "RSH6",
    S + """ SELECT product_id, (SELECT MAX(order_date) - MIN(order_date) + 1 FROM sales) AS days, COUNT(DISTINCT order_date) AS real_days,
      (SELECT MAX(order_date) - MIN(order_date) + 1 FROM sales) - COUNT(DISTINCT order_date) AS filled_days, SUM(quantity) AS sales FROM sales GROUP BY product_id""",
)
def item_series(spark, sf):
    dense = reshape.complete_series(daily_sales(sales(spark, sf)), "order_date", ["product_id"], ["sales"])
    return dense.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("data_source") == "REAL").alias("real_days"),
        F.count_if(F.col("data_source") == "FILLED").alias("filled_days"),
        F.sum("sales").alias("sales"),
    )


EXPOSURE_SQL = """m AS (SELECT product_id, YEAR(order_date) * 12 + MONTH(order_date) AS m, is_own, quantity FROM sales),
own AS (SELECT product_id, (SELECT MAX(m) FROM m WHERE is_own) - MIN(m) FILTER (quantity > 0) + 1 AS months FROM m WHERE is_own GROUP BY 1),
comp AS (SELECT product_id, COUNT(DISTINCT m) AS months FROM m WHERE NOT is_own GROUP BY 1)"""


def _exposure(spark, sf):
    s = sales(spark, sf)
    own = reshape.months_listed(s.filter("is_own"), "product_id", "order_date", "first_to_end", "quantity")
    rival = reshape.months_listed(s.filter("not is_own"), "product_id", "order_date", "distinct_months")
    return own, rival


@query("own_months_listed", "RSH7", S + f", {EXPOSURE_SQL} SELECT product_id, CAST(months AS INTEGER) AS months_listed FROM own")
def own_months(spark, sf):
    return _exposure(spark, sf)[0]


@query("competitor_months_listed", "RSH8", S + f", {EXPOSURE_SQL} SELECT product_id, months AS months_listed FROM comp")
def rival_months(spark, sf):
    return _exposure(spark, sf)[1]


@query(
    "resolved_exposure",
    "RSH9",
    S + f""", {EXPOSURE_SQL} SELECT p_partkey AS product_id, COALESCE(own.months, comp.months, (SELECT (YEAR(MAX(order_date)) - YEAR(MIN(order_date))) * 12 + MONTH(MAX(order_date)) - MONTH(MIN(order_date)) + 1 FROM sales)) AS months_listed,
      CASE WHEN own.months IS NOT NULL THEN 'own' WHEN comp.months IS NOT NULL THEN 'competitor' ELSE 'full_period' END AS exposure_source
      FROM part LEFT JOIN own ON own.product_id = p_partkey LEFT JOIN comp ON comp.product_id = p_partkey""",
)
def exposure(spark, sf):
    own, rival = _exposure(spark, sf)
    return reshape.resolve_exposure(products(spark, sf).select("product_id"), "product_id", own, rival, reshape.full_period(sales(spark, sf), "order_date")).withColumn("months_listed", F.col("months_listed").cast("long"))


@query(
    "suffix_columns_folded",
    "RSH10",
    "SELECT p_partkey, COALESCE(CASE WHEN p_size > 20 THEN p_size END, CASE WHEN p_size > 10 THEN p_size * 2 END, p_size * 3) AS size FROM part",
)
def folded(spark, sf):
    s = F.col("p_size")
    p = table(spark, sf, "part").select("p_partkey", F.when(s > 20, s).alias("size"), F.when(s > 10, s * 2).alias("size.x"), (s * 3).alias("size.y"))
    return reshape.coalesce_suffix(p)


# ---- places and trends -----------------------------------------------------------------------

PLACE_SQL = SALES_SQL + ", placed AS (SELECT sales.*, n_name AS country, r_name AS state FROM sales JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"


def _placed(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    place = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return sales(spark, sf).join(place.select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country"), F.col("r_name").alias("state")), "customer_id")


def _geo_sql(place: str, platform: str) -> str:
    return f"""WITH {PLACE_SQL} SELECT {platform} AS platform_id, {place}, f AS product_line_id, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
      {msum('lineproduct_price')} AS revenue FROM (SELECT *, UNNEST([product_line_id, 'all']) AS f FROM placed WHERE order_status IN ('shipped', 'delivered')) GROUP BY 1, 2, 3"""


@query("sales_by_country", "GEO1 FLT8", _geo_sql("country", "platform_id"))
def by_country(spark, sf):
    return geo.geo_country(_placed(spark, sf))


@query("sales_by_state", "GEO2", _geo_sql("state", "platform_id"))
def by_state(spark, sf):
    return geo.geo_state(_placed(spark, sf))


@query("sales_by_country_all_platforms", "GEO4", _geo_sql("country", "'all'"))
def by_country_all(spark, sf):
    return geo.geo_all(_placed(spark, sf), "country")


@query(
    "customer_country",
    "GEO3",
    S + """, c AS (SELECT customer_id, n_name AS country, COUNT(DISTINCT order_id) AS orders, MAX(order_date) AS last_order FROM sales JOIN supplier ON s_suppkey = supplier_id JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2)
      SELECT customer_id, country, orders FROM c QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY orders DESC, last_order DESC, country) = 1""",
)
def country_of(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    origin = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("supplier_id"), F.col("n_name").alias("country"))
    return geo.customer_country(order_lines(spark, sf).join(origin, "supplier_id"))


def _macro_sql(grain: str, platform: str = "platform_id") -> str:
    return f"""{SALES_SQL}, r AS (SELECT {platform} AS platform_id, UNNEST([product_line_id, 'all']) AS product_line_id, CAST(DATE_TRUNC('{grain}', order_date) AS DATE) AS period, order_id, customer_id, lineproduct_price FROM sales),
    a AS (SELECT platform_id, product_line_id, period, {msum('lineproduct_price')} AS revenue, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS active_customers FROM r GROUP BY 1, 2, 3),
    f AS (SELECT platform_id, product_line_id, p AS period, COUNT(*) AS new_customers FROM (SELECT platform_id, product_line_id, customer_id, MIN(period) AS p FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2, 3),
    macro AS (SELECT a.*, COALESCE(new_customers, 0) AS new_customers FROM a LEFT JOIN f USING (platform_id, product_line_id, period))"""


@query("macro_monthly", "MAC1", f"WITH {_macro_sql('month')} SELECT * FROM macro")
def monthly(spark, sf):
    return macro.macro_monthly(sales(spark, sf))


@query(
    "macro_growth",
    "MAC2 MAC4 WIN12",
    f"""WITH {_macro_sql('month')}, spine AS (SELECT platform_id, product_line_id, UNNEST(GENERATE_SERIES(MIN(period), MAX(period), INTERVAL 1 MONTH))::DATE AS period FROM macro GROUP BY 1, 2)
      SELECT platform_id, product_line_id, period, revenue, ROUND((revenue - m) / NULLIF(m, 0), 6) AS mom_growth, ROUND((revenue - y) / NULLIF(y, 0), 6) AS yoy_growth,
        (CAST(DATE_TRUNC('month', (SELECT MAX(o_orderdate) FROM orders)) AS DATE) = period AND (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders) < LAST_DAY((SELECT MAX(o_orderdate) FROM orders))) AS is_partial_month
      FROM (SELECT *, LAG(revenue) OVER w AS m, LAG(revenue, 12) OVER w AS y FROM spine LEFT JOIN macro USING (platform_id, product_line_id, period) WINDOW w AS (PARTITION BY platform_id, product_line_id ORDER BY period))""",
)
def growth(spark, sf):
    g = macro.flag_partial(macro.with_growth(macro.macro_monthly(sales(spark, sf))), as_of(spark, sf))
    return g.select("platform_id", "product_line_id", "period", "revenue", F.round("mom_growth", 6).alias("mom_growth"), F.round("yoy_growth", 6).alias("yoy_growth"), "is_partial_month")


@query("macro_quarterly", "MAC3", f"WITH {_macro_sql('quarter')} SELECT * FROM macro")
def quarterly(spark, sf):
    return macro.macro_period(sales(spark, sf), "quarter")


@query("macro_yearly", "MAC3", f"WITH {_macro_sql('year')} SELECT * FROM macro")
def yearly(spark, sf):
    return macro.macro_period(sales(spark, sf), "year")


@query("macro_category", "MAC5", f"WITH {_macro_sql('month', chr(39) + 'all' + chr(39))} SELECT * FROM macro")
def category(spark, sf):
    return macro.macro_category(sales(spark, sf))


# ---- Poisson drivers -------------------------------------------------------------------------

CALENDAR = [*[f"month_{m}" for m in range(1, 13)], *WEEKDAYS]
DUMMY_SQL = ", ".join([f"(MONTH(order_date) = {m}) AS month_{m}" for m in range(1, 13)] + [f"(ISODOW(order_date) = {i}) AS {d}" for i, d in enumerate(WEEKDAYS, 1)])
CALENDAR_LONG_SQL = f"""cal AS (SELECT product_line_id, sales, {DUMMY_SQL} FROM series),
cal_long AS (SELECT product_line_id, predictor, CAST(v AS INTEGER) AS x, sales AS y FROM (UNPIVOT cal ON {', '.join(CALENDAR)} INTO NAME predictor VALUE v))"""


def _calendar_levels(spark, sf):
    return poisson.compress(poisson.to_long(calendar_dummies(_line_series(spark, sf), "order_date"), CALENDAR))


def _calendar_fit(spark, sf):
    return poisson.fit(_calendar_levels(spark, sf))


CLOSED_SQL = f"""{SALES_SQL}, {GRID_SQL}, {CALENDAR_LONG_SQL},
c AS (SELECT product_line_id, predictor, COUNT(*) AS n, SUM(y) FILTER (x = 1) AS y1, SUM(y) FILTER (x = 0) AS y0, COUNT(*) FILTER (x = 1) AS n1, COUNT(*) FILTER (x = 0) AS n0 FROM cal_long GROUP BY 1, 2),
e AS (SELECT *, LN((y1 / n1) / (y0 / n0)) AS b, SQRT(1 / y1 + 1 / y0) AS se FROM c)"""


@query(
    "calendar_poisson",
    "POI1 POI10",
    f"""WITH {CLOSED_SQL} SELECT product_line_id, predictor, n AS sample_size, 'estimated' AS estimation_status, ROUND(b, 6) AS coefficient, ROUND(EXP(b), 6) AS incidence_rate_ratio, ROUND(se, 6) AS std_error,
      ROUND(b / se, 4) AS z_value, ROUND(b - 1.959963984540054 * se, 6) AS conf_low, ROUND(b + 1.959963984540054 * se, 6) AS conf_high FROM e""",
)
def calendar_poisson(spark, sf):
    f = _calendar_fit(spark, sf)
    digits = {"coefficient": 6, "incidence_rate_ratio": 6, "std_error": 6, "z_value": 4, "conf_low": 6, "conf_high": 6}
    return f.select(*poisson.MODEL, "sample_size", "estimation_status", *[F.round(c, d).alias(c) for c, d in digits.items()])


def _item_frame(spark, sf):
    """Items with their total quantity and numeric, partly unusable predictors."""
    total = order_lines(spark, sf).groupBy("product_id").agg(F.sum("quantity").alias("sales"))
    p = products(spark, sf)
    size = F.col("size")
    return p.join(total, "product_id", "left").select(
        "product_id", "product_line_id", "sales", size.cast("double").alias("size"), "retail_price",
        (F.col("brand") == "Brand#1").cast("double").alias("brand_one"), F.lit(7.0).alias("always_seven"), F.lit(None).cast("double").alias("unknown"),
        F.when(size == 1, F.lit(float("nan"))).otherwise(size % 2).cast("double").alias("odd_size"), size.alias("size.x"),
    )


ITEM_PREDICTORS = ["size", "retail_price", "brand_one", "always_seven", "unknown", "odd_size"]


ITEM_LONG_SQL = """tot AS (SELECT l_partkey, SUM(l_quantity) AS y FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
il AS (SELECT p_type AS product_line_id, UNNEST(['size','retail_price','brand_one','always_seven','unknown','odd_size']) AS predictor,
  UNNEST([CAST(p_size AS DOUBLE), p_retailprice, CAST(CAST(p_brand = 'Brand#1' AS INTEGER) AS DOUBLE), 7.0, NULL, CASE WHEN p_size > 1 THEN CAST(p_size % 2 AS DOUBLE) END]) AS x, y FROM part LEFT JOIN tot ON l_partkey = p_partkey)"""

GATE_SQL = """CASE WHEN nk = 0 THEN 'all_na_prefilter' WHEN xk = 1 THEN 'constant_prefilter' WHEN n < 3 THEN 'insufficient_rows' WHEN lv < 2 THEN 'constant_in_subset' END AS drop_reason"""


@query(
    "item_poisson",
    "POI1",
    f"""WITH RECURSIVE {ITEM_LONG_SQL}, s AS (SELECT product_line_id, predictor, COUNT(x) AS nk, COUNT(DISTINCT x) AS xk, COUNT(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n, COUNT(DISTINCT CASE WHEN y IS NOT NULL THEN x END) AS lv FROM il GROUP BY 1, 2),
      g AS (SELECT *, {GATE_SQL} FROM s), ok AS (SELECT product_line_id, predictor, x, y, 1.0 AS e FROM il JOIN g USING (product_line_id, predictor) WHERE drop_reason IS NULL), {newton_sql('ok', 'm')}
      SELECT product_line_id, predictor, g.n AS sample_size, CASE WHEN drop_reason IS NULL THEN 'estimated' WHEN drop_reason LIKE '%prefilter' THEN 'dropped' ELSE 'not_estimable' END AS estimation_status, drop_reason,
      ROUND(coefficient, 8) AS coefficient, ROUND(std_error, 8) AS std_error, ROUND(deviance, 4) AS deviance, ROUND(aic, 4) AS aic FROM g LEFT JOIN m USING (product_line_id, predictor)""",
)
def item_poisson(spark, sf):
    frame = _item_frame(spark, sf)
    chosen = poisson.select_predictors(frame)
    f = poisson.poisson_univariate(frame, chosen)
    return f.select(*poisson.MODEL, "sample_size", "estimation_status", "drop_reason", F.round("coefficient", 8).alias("coefficient"), F.round("std_error", 8).alias("std_error"), F.round("deviance", 4).alias("deviance"), F.round("aic", 4).alias("aic"))


# a size in another unit repeats `size`; `weight` is asked for but not there. Pairs are enough to see it in SQL.
ALIAS_SQL = ITEM_LONG_SQL + """, iw AS (SELECT p_type AS product_line_id, p_partkey AS item, UNNEST([1, 2, 3, 4, 5]) AS pos, UNNEST(['size', 'retail_price', 'brand_one', 'odd_size', 'size_cm']) AS predictor,
    UNNEST([CAST(p_size AS DOUBLE), p_retailprice, CAST(CAST(p_brand = 'Brand#1' AS INTEGER) AS DOUBLE), CAST(p_size % 2 AS DOUBLE), p_size * 2.5]) AS x FROM part WHERE p_size > 1),
  al AS (SELECT DISTINCT b.product_line_id, b.predictor FROM (SELECT a.product_line_id, b.predictor, ABS(CORR(a.x, b.x)) AS c FROM iw a JOIN iw b ON a.item = b.item AND a.pos < b.pos GROUP BY a.product_line_id, a.predictor, b.predictor) b WHERE c BETWEEN 1 - 1e-9 AND 1 + 1e-9),
  i2 AS (SELECT * FROM il UNION ALL SELECT product_line_id, 'size_cm', x * 2.5, y FROM il WHERE predictor = 'size')"""


@query(
    "predictor_estimability",
    "POI2 POI4 POI6",
    f"""WITH {ALIAS_SQL}, s AS (SELECT product_line_id, predictor, COUNT(x) AS nk, COUNT(DISTINCT x) AS xk, COUNT(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n, COUNT(DISTINCT CASE WHEN y IS NOT NULL THEN x END) AS lv FROM i2 GROUP BY 1, 2),
      g AS (SELECT s.*, al.predictor IS NOT NULL AS twin FROM s LEFT JOIN al USING (product_line_id, predictor))
      SELECT product_line_id, predictor, n AS sample_size, lv AS n_levels, CASE WHEN nk = 0 OR xk = 1 THEN 'dropped' WHEN n < 3 OR lv < 2 OR twin THEN 'not_estimable' ELSE 'estimated' END AS estimation_status,
      CASE WHEN nk = 0 THEN 'all_na_prefilter' WHEN xk = 1 THEN 'constant_prefilter' WHEN n < 3 THEN 'insufficient_rows' WHEN lv < 2 THEN 'constant_in_subset' WHEN twin THEN 'aliased' END AS drop_reason FROM g
      UNION ALL SELECT DISTINCT p_type, 'weight', 0, 0, 'not_estimable', 'missing_column' FROM part""",
)
def estimability(spark, sf):
    frame = _item_frame(spark, sf).withColumn("size_cm", F.col("size") * 2.5)
    chosen = poisson.select_predictors(frame)
    gate = poisson.estimability(poisson.compress(poisson.to_long(frame, chosen)))
    return aliasing.with_structure(gate, frame, [*chosen, "weight"])


@query(
    "predictor_ranges",
    "POI3",
    f"""WITH {ITEM_LONG_SQL} SELECT product_line_id, predictor, MIN(x) AS predictor_min, MAX(x) AS predictor_max, MAX(x) - MIN(x) AS predictor_range,
      MIN(x) = 0 AND MAX(x) = 1 AND COUNT(*) FILTER (x NOT IN (0, 1)) = 0 AS predictor_is_binary, CASE WHEN MAX(x) > MIN(x) THEN 100 / (MAX(x) - MIN(x)) ELSE 100.0 END AS track_multiplier
      FROM il WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2""",
)
def ranges(spark, sf):
    frame = _item_frame(spark, sf)
    return poisson.predictor_ranges(poisson.compress(poisson.to_long(frame, poisson.select_predictors(frame))))


@query(
    "lines_without_model",
    "POI5 MKT7",
    f"""WITH {ITEM_LONG_SQL}, has AS (SELECT DISTINCT product_line_id FROM il WHERE product_line_id < 'P')
      SELECT p_type AS product_line_id, '__no_data__' AS predictor, 'no_series' AS drop_reason FROM part WHERE p_type NOT IN (SELECT product_line_id FROM has) GROUP BY 1
      UNION ALL SELECT DISTINCT product_line_id, predictor, CASE predictor WHEN 'unknown' THEN 'all_na_prefilter' WHEN 'always_seven' THEN 'constant_prefilter' END FROM il WHERE product_line_id < 'P'""",
)
def without_model(spark, sf):
    frame = _item_frame(spark, sf)
    gate = poisson.estimability(poisson.compress(poisson.to_long(frame.filter("product_line_id < 'P'"), poisson.select_predictors(frame))))
    return poisson.sentinels(products(spark, sf), gate).select("product_line_id", "predictor", "drop_reason")


@query(
    "unanalysable_predictors",
    "POI6",
    f"""WITH {ITEM_LONG_SQL}, s AS (SELECT product_line_id, predictor, COUNT(x) AS nk, COUNT(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n FROM il WHERE predictor IN ('unknown', 'always_seven') GROUP BY 1, 2)
      SELECT product_line_id, predictor, 'dropped' AS estimation_status, CASE WHEN nk = 0 THEN 'all_na_prefilter' ELSE 'constant_prefilter' END AS drop_reason, n AS sample_size FROM s""",
)
def unanalysable(spark, sf):
    frame = _item_frame(spark, sf)
    return poisson.analyzability_audit(poisson.estimability(poisson.compress(poisson.to_long(frame, poisson.select_predictors(frame)))))


@query(
    "predictor_types_and_names",
    "POI7 POI8",
    "SELECT product_line_id, predictor, CASE WHEN predictor = 'monday' THEN 'weekday' ELSE 'time_feature' END AS predictor_type, CASE WHEN predictor = 'monday' THEN 'Lundi' WHEN predictor LIKE 'month%' THEN UPPER(predictor) ELSE predictor END AS display_name FROM ("
    + f"WITH {SALES_SQL} SELECT DISTINCT product_line_id, UNNEST([{', '.join(chr(39) + c + chr(39) for c in CALENDAR)}]) AS predictor FROM sales)",
)
def types_names(spark, sf):
    levels = _calendar_levels(spark, sf).select(*poisson.MODEL).distinct()
    own = levels.filter("predictor = 'monday'").select("predictor", F.lit("weekday").alias("predictor_type"))
    names = levels.filter("predictor = 'monday' or predictor like 'month%'").select(
        "predictor", F.upper("predictor").alias("name_en"), F.when(F.col("predictor") == "monday", "Lundi").alias("name_fr")
    )
    return labels.with_display_names(labels.classify_predictor(levels, own), names, "fr").select(*poisson.MODEL, "predictor_type", "display_name")


@query(
    "driver_significance",
    "POI9",
    f"""WITH {CLOSED_SQL} SELECT product_line_id, COUNT(*) AS n_estimated, CAST(0 AS BIGINT) AS n_not_estimated, COUNT(*) FILTER (ABS(b / se) > 1.959963984540054) AS n_p05, COUNT(*) FILTER (ABS(b / se) > 3.290526731491926) AS n_p001 FROM e GROUP BY 1""",
)
def driver_significance(spark, sf):
    return poisson.significance(_calendar_fit(spark, sf))


def _latest_year(spark, sf) -> int:
    return table(spark, sf, "orders").agg(F.year(F.max("o_orderdate"))).first()[0]


@query(
    "coefficient_time_labels",
    "POI10 FN9 FN18 SRT3",
    f"""WITH {SALES_SQL}, y AS (SELECT CAST(YEAR(MAX(o_orderdate)) AS INTEGER) AS y FROM orders), l AS (SELECT DISTINCT product_line_id, UNNEST(['year','day','size',{', '.join(chr(39) + c + chr(39) for c in CALENDAR)}]) AS predictor FROM sales),
    p AS (SELECT l.*, y, TRY_CAST(REGEXP_EXTRACT(predictor, '^month_(\\d+)$', 1) AS INTEGER) AS m, LIST_POSITION(['monday','tuesday','wednesday','thursday','friday','saturday','sunday'], predictor) AS wd FROM l, y)
    SELECT product_line_id, predictor, CASE WHEN predictor = 'year' OR m IS NOT NULL THEN y END AS analysis_year, m AS analysis_month, CAST(CEIL(m / 3.0) AS INTEGER) AS analysis_quarter,
      CASE WHEN predictor = 'year' THEN 'year' WHEN m IS NOT NULL THEN 'month' WHEN predictor = 'day' THEN 'day' WHEN wd > 0 THEN 'weekday' ELSE 'other' END AS time_hierarchy,
      CASE WHEN predictor = 'year' THEN 'yearly' WHEN m IS NOT NULL THEN 'monthly' WHEN predictor = 'day' THEN 'daily' WHEN wd > 0 THEN 'weekly' END AS time_granularity,
      CASE WHEN predictor = 'year' THEN y || '年' END AS year_label, CASE WHEN m IS NOT NULL THEN y || '年' || m || '月' END AS month_label, CASE WHEN m IS NOT NULL THEN y || '年Q' || CAST(CEIL(m / 3.0) AS INTEGER) END AS quarter_label,
      CASE WHEN wd > 0 THEN ['週一','週二','週三','週四','週五','週六','週日'][wd] END AS week_label, CASE WHEN predictor = 'day' THEN '每月日期效應' END AS day_label,
      CASE WHEN predictor = 'year' THEN MAKE_DATE(y, 1, 1) WHEN m IS NOT NULL THEN MAKE_DATE(y, m, 1) END AS date_start, CASE WHEN predictor = 'year' THEN MAKE_DATE(y, 12, 31) WHEN m IS NOT NULL THEN LAST_DAY(MAKE_DATE(y, m, 1)) END AS date_end,
      CAST(CASE WHEN predictor = 'year' THEN MAKE_DATE(y, 12, 31) - MAKE_DATE(y, 1, 1) + 1 WHEN m IS NOT NULL THEN LAST_DAY(MAKE_DATE(y, m, 1)) - MAKE_DATE(y, m, 1) + 1 END AS INTEGER) AS period_days,
      CAST(CASE WHEN predictor = 'year' THEN 1000 WHEN m IS NOT NULL THEN 3000 + m WHEN predictor = 'day' THEN 5000 WHEN wd > 0 THEN 4000 + wd ELSE 9999 END AS INTEGER) AS display_order FROM p""",
)
def time_labels(spark, sf):
    year = _latest_year(spark, sf)
    names = F.explode(F.array(*[F.lit(c) for c in ["year", "day", "size", *CALENDAR]]))
    lines = sales(spark, sf).select("product_line_id").distinct().withColumn("predictor", names)
    return labels.label_coefficients(lines, year)


@query(
    "coefficients_by_hierarchy",
    "AGG14",
    f"""WITH {CLOSED_SQL} SELECT CASE WHEN predictor LIKE 'month%' THEN 'month' ELSE 'weekday' END AS time_hierarchy, COUNT(*) AS n, COUNT(*) AS n_labelled, ROUND(AVG(EXP(b)), 6) AS mean_irr FROM e GROUP BY 1""",
)
def by_hierarchy(spark, sf):
    return summary_by_hierarchy(labels.label_coefficients(_calendar_fit(spark, sf), _latest_year(spark, sf))).withColumn("mean_irr", F.round("mean_irr", 6))


@query("top_calendar_drivers", "SRT4", f"WITH {CLOSED_SQL} SELECT product_line_id, predictor, ROUND(b, 6) AS coefficient FROM e ORDER BY ABS(b / se) DESC LIMIT 8")
def top_drivers(spark, sf):
    return top_significant(_calendar_fit(spark, sf), poisson.MODEL, 8).select(*poisson.MODEL, F.round("coefficient", 6).alias("coefficient"))


@query("series_data_version", "POI11", S + " SELECT product_line_id, MAX(order_date) AS data_version, CAST(MAX(order_date) - MIN(order_date) + 1 AS INTEGER) AS span_days FROM sales GROUP BY 1")
def version(spark, sf):
    return poisson.data_version(sales(spark, sf), "order_date")
