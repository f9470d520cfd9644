"""Registered review, position, market, recommendation, segment and product queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.text import fingerprint
from martloom.operators import customer, imputation, lookup, market, poisson, position, products as prod, recommend, reshape, reviews as rev, segments
from martloom.plans.commerce import BINARY_TOPICS, RATINGS_SQL, REVIEWS_SQL, SALES_SQL, TOPICS, as_of, order_lines, products, ratings_long, reviews, rmean, sales, table
from martloom.plans.newton import negbin_sql, newton_sql, normal_tail_sql
from martloom.plans.registry import query
from martloom.session import materialise

S = "WITH " + SALES_SQL
R = "WITH " + REVIEWS_SQL
RT = "WITH " + RATINGS_SQL
LINES = ["ECONOMY", "STANDARD", "PROMO", "LARGE", "SMALL", "MEDIUM"]
OWN_SQL = "('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5')"


# ---- reviews ---------------------------------------------------------------------------------

ASIN_SQL = "'B' || LPAD(CAST(product_id AS VARCHAR), CASE WHEN review_id % 10 = 0 THEN 6 ELSE 9 END, '0')"
RAW_SQL = f"""raw AS (SELECT review_id, {ASIN_SQL} AS variation, CASE WHEN review_id % 7 > 0 THEN review_date END AS review_date, CASE WHEN review_id % 5 > 0 THEN rating END AS rating, review_body AS body FROM reviews),
st AS (SELECT *, CAST(YEAR(review_date) AS INTEGER) AS review_year, CAST(MONTH(review_date) AS INTEGER) AS review_month, CAST(LENGTH(body) AS INTEGER) AS body_length FROM raw WHERE REGEXP_MATCHES(variation, '^[A-Z0-9]{{10}}$'))"""


def _raw_reviews(spark, sf):
    k = F.col("review_id")
    asin = F.concat(F.lit(" B"), F.lpad(F.col("product_id").cast("string"), 9, "0"), F.lit(" "))
    short = F.concat(F.lit("B"), F.lpad(F.col("product_id").cast("string"), 6, "0"))
    said = F.concat(F.lit("Reviewed in Canada on "), F.date_format("review_date", "MMMM d, yyyy"))
    return reviews(spark, sf).select(
        "review_id", F.when(k % 10 == 0, short).otherwise(asin).alias("variation"), F.when(k % 7 > 0, said).otherwise("unknown").alias("date"),
        F.when(k % 5 > 0, F.col("rating").cast("string")).otherwise("n/a").alias("rating"), F.col("review_body").alias("body"),
    )


@query(
    "staged_reviews",
    "REV1 FN4 FLT3",
    f"""{R}, {RAW_SQL} SELECT review_id, variation, review_date, rating, review_year, review_month, body_length,
      ROUND((SELECT 100.0 * SUM(CAST(LENGTH(TRIM(body)) > 0 AND rating IS NOT NULL AND review_date IS NOT NULL AS INTEGER)) / COUNT(*) FROM st), 6) AS quality_pct FROM st""",
)
def staged(spark, sf):
    s = rev.stage_reviews(_raw_reviews(spark, sf))
    return s.select("review_id", "variation", "review_date", "rating", "review_year", "review_month", "body_length", F.round("quality_pct", 6).alias("quality_pct"))


@query(
    "transformed_reviews",
    "REV2 SRC11 JN12 FN20",
    f"""{R}, {RAW_SQL}, c AS (SELECT DISTINCT 'B' || LPAD(CAST(p_partkey AS VARCHAR), 9, '0') AS asin FROM part WHERE p_brand NOT IN {OWN_SQL}),
      t AS (SELECT st.*, CASE WHEN review_id % 9 < 6 THEN {LINES}[CAST(review_id % 9 + 1 AS INTEGER)] END AS line FROM st)
      SELECT review_id, variation AS product_id, line AS product_line_id, variation IN (SELECT asin FROM c) AS included_competitor,
        CASE WHEN line IS NULL THEN 30 WHEN rating IS NOT NULL AND review_date IS NOT NULL AND body IS NOT NULL THEN 100 WHEN rating IS NOT NULL AND review_date IS NOT NULL THEN 85 WHEN rating IS NOT NULL THEN 70 ELSE 50 END AS final_quality_score FROM t""",
)
def transformed(spark, sf):
    path = F.concat(F.lit("/drop/reviews/"), F.format_string("%03d", F.col("review_id") % 9 + 1), F.lit("/page.csv"))
    s = rev.stage_reviews(_raw_reviews(spark, sf)).withColumn("path", path).withColumn("platform_id", F.lit("amz"))
    c = products(spark, sf).filter("not is_own").select(F.concat(F.lit("B"), F.lpad(F.col("product_id").cast("string"), 9, "0")).alias("product_id"))
    return rev.transform_reviews(s, LINES, c).select("review_id", "product_id", "product_line_id", "included_competitor", "final_quality_score")


TOPIC_DEF_SQL = "topics AS (SELECT DISTINCT p_type AS product_line_id, UNNEST(['comfort','durability','fit','price_value','safety']) AS topic FROM part)"


def _topics(spark, sf):
    names = F.explode(F.array(*[F.lit(t) for t in TOPICS]))
    return products(spark, sf).select("product_line_id").distinct().withColumn("topic", names)


def _frame(spark, sf, n=3):
    p = products(spark, sf).select("product_line_id", F.col("product_id"), (~F.col("is_own")).alias("included_competitor"))
    # several reviews per item: items are grouped by twenty
    r = reviews(spark, sf).select("review_id", "review_date", "product_id").join(p, "product_id").withColumn("product_id", F.col("product_id") % 20)
    defs = _topics(spark, sf).withColumn("definition", F.concat(F.lit("How is "), "topic"))
    return rev.rating_frame(r, _topics(spark, sf), defs.filter("topic <> 'fit'"), n)


FRAME_SQL = f"""{REVIEWS_SQL}, rr AS (SELECT review_id, review_date, product_id % 20 AS product_id, p_type AS product_line_id, p_brand NOT IN {OWN_SQL} AS included_competitor FROM reviews JOIN part ON p_partkey = product_id),
kept AS (SELECT * FROM rr WHERE included_competitor QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY review_date DESC, review_id) <= 3),
frame AS (SELECT kept.*, topic, CASE WHEN topic <> 'fit' THEN 'How is ' || topic END AS definition FROM kept CROSS JOIN (SELECT UNNEST(['comfort','durability','fit','price_value','safety']) AS topic))"""


@query("rating_work_frame", "REV3 WIN5 RSH2 JN19", f"WITH {FRAME_SQL} SELECT review_id, product_id, product_line_id, topic, definition FROM frame")
def frame(spark, sf):
    return _frame(spark, sf).select("review_id", "product_id", "product_line_id", "topic", "definition")


RESULT_SQL = """res AS (SELECT doc_id AS review_id, topic, 'm1' AS model, DATE '2024-01-01' + attempt AS rated_at, CASE WHEN (doc_id + attempt) % 4 = 0 THEN 'Connection_error' ELSE CAST(n_chars % 6 AS VARCHAR) END AS result
  FROM documents CROSS JOIN (SELECT UNNEST(['comfort','safety']) AS topic) CROSS JOIN (SELECT UNNEST([0, 1]) AS attempt) WHERE attempt <= n_chars % 2)"""


def _results(spark, sf):
    attempts = F.explode(F.sequence(F.lit(0), (F.col("n_chars") % 2).cast("int")))
    d = table(spark, sf, "documents").select("doc_id", "n_chars", F.explode(F.array(F.lit("comfort"), F.lit("safety"))).alias("topic")).withColumn("attempt", attempts)
    return d.select(
        F.col("doc_id").alias("review_id"), "topic", F.lit("m1").alias("model"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("attempt")).alias("rated_at"),
        F.when((F.col("doc_id") + F.col("attempt")) % 4 == 0, "Connection_error").otherwise((F.col("n_chars") % 6).cast("string")).alias("result"),
    )


@query(
    "pending_ratings",
    "REV4 JN19",
    f"""WITH {FRAME_SQL}, {RESULT_SQL}, newest AS (SELECT * FROM res QUALIFY ROW_NUMBER() OVER (PARTITION BY review_id, topic ORDER BY rated_at DESC) = 1)
      SELECT review_id, topic, 'm1' AS model FROM frame WHERE (review_id, topic) NOT IN (SELECT review_id, topic FROM newest WHERE result <> 'Connection_error')""",
)
def pending(spark, sf):
    work = _frame(spark, sf).select("review_id", "topic", F.lit("m1").alias("model"))
    return rev.pending(work, _results(spark, sf))


@query("rating_history", "REV4", f"WITH {RESULT_SQL} SELECT review_id, topic, model, rated_at AS valid_from, result, LEAD(rated_at) OVER w AS valid_to, LEAD(rated_at) OVER w IS NULL AS is_current FROM res WINDOW w AS (PARTITION BY review_id, topic, model ORDER BY rated_at, result)")
def history(spark, sf):
    return rev.result_history(_results(spark, sf))


@query("failed_ratings", "REV5", f"WITH {RESULT_SQL} SELECT * FROM res WHERE result LIKE '%Connection_error%'")
def failed(spark, sf):
    return rev.retry_set(_results(spark, sf))


@query("item_topic_means", "REV6 JN8", RT + " SELECT product_line_id, product_id, topic, AVG(rating) AS rating FROM ratings GROUP BY 1, 2, 3")
def topic_means(spark, sf):
    return rev.ratings_by_item(ratings_long(spark, sf))


@query(
    "imputed_topic_means",
    "REV7",
    RT + """, i AS (SELECT product_line_id, product_id, topic, AVG(rating) AS rating FROM ratings GROUP BY 1, 2, 3)
      SELECT product_line_id, product_id, topic, ROUND(COALESCE(rating, AVG(rating) OVER (PARTITION BY product_line_id, topic), AVG(rating) OVER (PARTITION BY topic)), 6) AS rating, rating IS NULL AS imputed FROM i""",
)
def imputed(spark, sf):
    return rev.impute(rev.ratings_by_item(ratings_long(spark, sf))).withColumn("rating", F.round("rating", 6))


def _chained(spark, sf):
    p = products(spark, sf).select("product_line_id", "product_id")
    return imputation.impute_chained(rev.ratings_by_item(ratings_long(spark, sf)), p, _topics(spark, sf))


@query("chained_ratings", "REV7")
def chained(spark, sf):
    return _chained(spark, sf).withColumns({c: F.round(c, 6) for c in ("rating", "spread")})


# what no draw may change: the whole grid, its observed means, and the observed range of each topic in its line
@query(
    "chained_rating_invariants",
    "REV7",
    RT + """, i AS (SELECT product_id, topic, AVG(rating) AS rating FROM ratings GROUP BY 1, 2)
      SELECT p_type AS product_line_id, p_partkey AS product_id, t.topic, rating IS NULL AS imputed, ROUND(rating, 6) AS observed, TRUE AS in_range
      FROM part CROSS JOIN topics t LEFT JOIN i ON i.product_id = p_partkey AND i.topic = t.topic""",
)
def chained_invariants(spark, sf):
    found = materialise(_chained(spark, sf), "chained")
    seen = found.filter("not imputed")
    line = seen.groupBy("product_line_id", "topic").agg(F.min("rating").alias("_lo"), F.max("rating").alias("_hi"))
    overall = seen.groupBy("topic").agg(F.min("rating").alias("_least"), F.max("rating").alias("_most"))
    both = found.join(line, ["product_line_id", "topic"], "left").join(overall, "topic", "left")
    inside = F.col("rating").between(F.coalesce("_lo", "_least"), F.coalesce("_hi", "_most"))
    return both.select("product_line_id", "product_id", "topic", "imputed", F.when(~F.col("imputed"), F.round("rating", 6)).alias("observed"), inside.alias("in_range"))


# ---- position and market ---------------------------------------------------------------------

PIVOT_SQL = ", ".join(f"AVG(rating) FILTER (topic = '{t}') AS {t}" for t in TOPICS)
SALES_SOURCE_SQL = """own AS (SELECT product_id, SUM(quantity) AS q FROM sales WHERE is_own GROUP BY 1), comp AS (SELECT product_id, SUM(quantity) AS q FROM sales WHERE NOT is_own GROUP BY 1)"""


def _totals(spark, sf):
    s = sales(spark, sf)
    total = lambda d: d.groupBy("product_id").agg(F.sum("quantity").alias("sales"))
    return total(s.filter("is_own")), total(s.filter("not is_own"))


def _position(spark, sf):
    own, comp = _totals(spark, sf)
    return position.position(ratings_long(spark, sf), TOPICS, own, comp, products(spark, sf))


@query(
    "item_positions",
    "POS1 JN9 JN16 AGG3",
    RT + ", " + SALES_SQL + f", {SALES_SOURCE_SQL}, w AS (SELECT product_line_id, product_id, {PIVOT_SQL} FROM ratings GROUP BY 1, 2)" + f"""
      SELECT w.*, COALESCE(own.q, comp.q, 0.0) AS sales, CASE WHEN own.q IS NOT NULL THEN 'own' WHEN comp.q IS NOT NULL THEN 'competitor' ELSE 'none' END AS sales_source, p_brand AS brand, p_brand IN {OWN_SQL} AS is_own
      FROM w JOIN part ON p_partkey = w.product_id LEFT JOIN own ON own.product_id = w.product_id LEFT JOIN comp ON comp.product_id = w.product_id""",
)
def positions(spark, sf):
    return _position(spark, sf)


@query(
    "series_with_topic_ratings",
    "JN9",
    RT + ", " + SALES_SQL + ", w AS (SELECT product_id, " + ", ".join(f"AVG(rating) FILTER (topic = '{t}') AS {t}_rating" for t in TOPICS) + " FROM ratings GROUP BY 1), t AS (SELECT product_id, SUM(quantity) AS sales FROM sales GROUP BY 1) SELECT * FROM t LEFT JOIN w USING (product_id)",
)
def series_ratings(spark, sf):
    wide = reshape.ratings_wide(ratings_long(spark, sf), ["product_id"], TOPICS)
    total = order_lines(spark, sf).groupBy("product_id").agg(F.sum("quantity").alias("sales"))
    return lookup.join_ratings(total, wide, "product_id")


PROPS_SQL = f"""props AS (SELECT *, CASE topic WHEN 'comfort' THEN 'attribute' WHEN 'durability' THEN 'attribute' WHEN 'fit' THEN 'scene' WHEN 'safety' THEN 'emotion' ELSE 'hidden' END AS type FROM (
  SELECT DISTINCT p_type AS product_line_id, UNNEST(['comfort','durability','fit','price_value','safety','colour']) AS topic FROM part))"""


def _properties(spark, sf):
    topic = F.col("topic")
    kind = F.when(topic.isin("comfort", "durability"), "attribute").when(topic == "fit", "scene").when(topic == "safety", "emotion").otherwise("hidden")
    lines = products(spark, sf).select("product_line_id").distinct()
    return lines.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in [*TOPICS, "colour"]]))).withColumn("type", kind)


@query(
    "topic_coverage_audit",
    "POS2",
    RT + f""", {PROPS_SQL}, it AS (SELECT product_line_id, product_id, topic, COUNT(rating) AS n FROM ratings GROUP BY 1, 2, 3),
      ni AS (SELECT product_line_id, COUNT(DISTINCT product_id) AS n_items FROM it GROUP BY 1), nr AS (SELECT product_line_id, topic, COUNT(*) FILTER (n > 0) AS n_rated FROM it GROUP BY 1, 2)
      SELECT product_line_id, topic, n_items, COALESCE(n_rated, 0) AS n_rated, ROUND(CAST(COALESCE(n_rated, 0) AS DOUBLE) / n_items * 100, 6) AS coverage_pct,
      CASE WHEN type NOT IN ('attribute', 'scene', 'emotion') THEN 'type_not_scored' WHEN COALESCE(n_rated, 0) = 0 THEN 'not_rated' WHEN CAST(n_rated AS DOUBLE) / n_items < 0.3 THEN 'low_coverage' WHEN type NOT IN ('attribute', 'scene') THEN 'not_display_type' ELSE 'displayed' END AS fate
      FROM props LEFT JOIN ni USING (product_line_id) LEFT JOIN nr USING (product_line_id, topic)""",
)
def coverage_audit(spark, sf):
    out = position.topic_coverage(_properties(spark, sf), ratings_long(spark, sf), ["attribute", "scene", "emotion"], ["attribute", "scene"])
    return out.withColumn("coverage_pct", F.round("coverage_pct", 6))


@query(
    "competitor_benchmark",
    "POS3",
    RT + f""", i AS (SELECT product_line_id, product_id, topic, AVG(rating) AS rating FROM ratings WHERE NOT is_own GROUP BY 1, 2, 3)
      SELECT product_line_id, topic, COUNT(rating) AS n, ROUND({rmean('rating')}, 6) AS mean, ROUND(STDDEV_SAMP(rating), 6) AS sd, QUANTILE_CONT(rating, 0.25) AS p25, QUANTILE_CONT(rating, 0.5) AS p50, QUANTILE_CONT(rating, 0.75) AS p75
      FROM i WHERE rating IS NOT NULL GROUP BY 1, 2""",
)
def benchmark(spark, sf):
    items = ratings_long(spark, sf).groupBy("product_line_id", "product_id", "topic", "is_own").agg(F.avg("rating").alias("rating"))
    return position.benchmark(items).withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


def _monthly(spark, sf):
    """Sales of each product and month, the only pass over the sales lines; `sold` is the largest quantity."""
    month = F.trunc("order_date", "month").alias("order_date")
    totals = sales(spark, sf).groupBy("product_id", "is_own", month).agg(F.sum("quantity").alias("quantity"), F.max("quantity").alias("sold"))
    return materialise(totals, "product-months")


def _topic_frame(spark, sf, rivals_only=False):
    """Long model rows: item means of the modelable topics, and brands, against item sales.

    The entry model of competitors looks at every topic.
    """
    months = _monthly(spark, sf)
    total = lambda d: d.groupBy("product_id").agg(F.sum("quantity").alias("sales"))
    own, comp = total(months.filter("is_own")), total(months.filter("not is_own"))
    p = products(spark, sf)
    items = lookup.fill_sales(p.select("product_id", "product_line_id", "is_own", "brand", "size"), own, comp, "product_id")
    o_months = reshape.months_listed(months.filter("is_own"), "product_id", "order_date", "first_to_end", "sold")
    c_months = reshape.months_listed(months.filter("not is_own"), "product_id", "order_date", "distinct_months")
    items = reshape.resolve_exposure(items, "product_id", o_months, c_months, reshape.full_period(months, "order_date"))
    means = reshape.binarise(rev.ratings_by_item(ratings_long(spark, sf)), BINARY_TOPICS)
    topics = means.select("product_id", "product_line_id", F.col("topic").alias("predictor"), F.col("rating").alias("x"))
    if not rivals_only:
        topics = market.modelable_topics(topics, _properties(spark, sf))
    hot = reshape.one_hot(items.select("product_id", "brand"), ["product_id"], ["brand"])
    indicators = market.dense_indicators(items, hot, "product_id")
    return items, market.market_frame(items.filter("not is_own") if rivals_only else items, "product_id", indicators, topics)


# Rivals' sales against the item mean of each topic; two-level topics are 1 when mentioned.
ENTRY_SQL = "WITH RECURSIVE " + SALES_SQL + ", " + RATINGS_SQL + """, q AS (SELECT product_id, SUM(quantity) AS q FROM sales WHERE NOT is_own GROUP BY 1),
  i AS (SELECT product_line_id, product_id, topic, AVG(rating) AS r FROM ratings WHERE NOT is_own GROUP BY 1, 2, 3),
  f AS (SELECT product_line_id, topic AS predictor, CASE WHEN topic = 'safety' THEN CAST(CAST(r > 0 AS INTEGER) AS DOUBLE) ELSE r END AS x, COALESCE(q, 0.0) AS y, 1.0 AS e FROM i LEFT JOIN q USING (product_id)),
  g AS (SELECT product_line_id, predictor, COUNT(x) AS n, COUNT(DISTINCT x) AS lv, SUM(y) FILTER (x IS NOT NULL) AS t, COUNT(DISTINCT x) = 2 AND MIN(x) = 0 AND MAX(x) = 1 AND LEAST(SUM(y) FILTER (x = 0), SUM(y) FILTER (x = 1)) = 0 AS empty_side FROM f GROUP BY 1, 2),
  ok AS (SELECT f.* FROM f JOIN g USING (product_line_id, predictor) WHERE n >= 3 AND lv >= 2 AND t > 0 AND NOT empty_side)"""


@query(
    "market_entry_model",
    "POS4",
    ENTRY_SQL + f""", {newton_sql('ok', 'm')} SELECT product_line_id, predictor, g.n AS sample_size, ROUND(coefficient, 8) AS coefficient, ROUND(p_value, 8) AS p_value,
      CASE WHEN g.n < 8 OR lv < 2 THEN 'withheld' WHEN coefficient IS NOT NULL THEN 'usable' ELSE 'not_estimable' END AS verdict FROM g LEFT JOIN m USING (product_line_id, predictor)""",
)
def entry(spark, sf):
    _, frame = _topic_frame(spark, sf, rivals_only=True)
    topics = frame.filter(F.col("predictor").isin(TOPICS)).withColumn("exposure", F.lit(1.0))
    out = position.entry_model(topics)
    return out.select(*poisson.MODEL, "sample_size", F.round("coefficient", 8).alias("coefficient"), F.round("p_value", 8).alias("p_value"), "verdict")


FRAME_SIZE_SQL = S + ", " + RATINGS_SQL + """, n AS (SELECT p_type AS product_line_id, COUNT(*) AS items FROM part GROUP BY 1), b AS (SELECT p_type AS product_line_id, 'brand::' || p_brand AS predictor, CAST(COUNT(*) AS DOUBLE) AS sum_x FROM part GROUP BY 1, 2),
  t AS (SELECT product_line_id, topic AS predictor, COUNT(*) AS n, COUNT(rating) AS n_known FROM (SELECT product_line_id, product_id, topic, AVG(rating) AS rating FROM ratings WHERE topic IN ('comfort', 'durability') GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


@query(
    "market_model_input",
    "MKT1 RSH5 MKT5",
    FRAME_SIZE_SQL + " SELECT product_line_id, predictor, items AS n, items AS n_known FROM b JOIN n USING (product_line_id) UNION ALL SELECT product_line_id, predictor, n, n_known FROM t",
)
def market_input(spark, sf):
    _, frame = _topic_frame(spark, sf)
    return frame.groupBy(*poisson.MODEL).agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_known"))


# theta and what hangs on it are settled to about nine digits
MARKET_DIGITS = {"coefficient": 6, "std_error": 6, "p_value": 6, "irr_display": 5}


def _market(spark, sf, overdispersed=market.OVERDISPERSED):
    _, frame = _topic_frame(spark, sf)
    return market.market_model(frame, overdispersed=overdispersed)


def _scales(spark, sf):
    t = _topics(spark, sf)
    return t.select("product_line_id", F.col("topic").alias("predictor"), F.when(F.col("topic").isin(BINARY_TOPICS), "2尺度").otherwise("5尺度").alias("scale"))


# Items with sales and exposure, then sums per line and per brand. A 0/1 attribute with exposure has a closed
# form: its rate ratio is (sum y1 / sum e1) / (sum y0 / sum e0).
BRAND_SUMS_SQL = S + """, m AS (SELECT product_id, YEAR(order_date) * 12 + MONTH(order_date) AS m, is_own, quantity FROM sales),
      own AS (SELECT product_id, (SELECT MAX(m) FROM m WHERE is_own) - MIN(m) FILTER (quantity > 0) + 1 AS months FROM m WHERE is_own GROUP BY 1), comp AS (SELECT product_id, COUNT(DISTINCT m) AS months FROM m WHERE NOT is_own GROUP BY 1),
      it AS (SELECT p_type AS product_line_id, p_brand, COALESCE(q, 0) AS y, COALESCE(own.months, comp.months, (SELECT MAX(m) - MIN(m) + 1 FROM m)) AS e FROM part LEFT JOIN (SELECT product_id, SUM(quantity) AS q FROM sales GROUP BY 1) s ON s.product_id = p_partkey
         LEFT JOIN own ON own.product_id = p_partkey LEFT JOIN comp ON comp.product_id = p_partkey),
      lt AS (SELECT product_line_id, SUM(y) AS y, SUM(e) AS e FROM it GROUP BY 1), bt AS (SELECT product_line_id, p_brand, SUM(y) AS y, SUM(e) AS e FROM it GROUP BY 1, 2)"""


# Every brand as a 0/1 attribute of all items of its line, and the item means of the two modelable topics.
MARKET_SQL = BRAND_SUMS_SQL.replace("WITH ", "WITH RECURSIVE ", 1).replace("it AS (SELECT p_type AS product_line_id, p_brand,", "it AS (SELECT p_type AS product_line_id, p_partkey, p_brand,") + ", " + RATINGS_SQL.removeprefix(SALES_SQL + ", ") + f""",
  f AS (SELECT it.product_line_id, 'brand::' || bt.p_brand AS predictor, CAST(CAST(it.p_brand = bt.p_brand AS INTEGER) AS DOUBLE) AS x, it.y, CAST(it.e AS DOUBLE) AS e, it.p_brand IN {OWN_SQL} AS is_own FROM it JOIN bt USING (product_line_id)
    UNION ALL SELECT it.product_line_id, topic, r, it.y, it.e, it.p_brand IN {OWN_SQL} FROM it JOIN (SELECT product_id, topic, AVG(rating) AS r FROM ratings WHERE topic IN ('comfort', 'durability') GROUP BY 1, 2) i ON i.product_id = p_partkey),
  k AS (SELECT product_line_id, predictor, COUNT(x) AS n, COUNT(DISTINCT x) AS lv, SUM(y) FILTER (x IS NOT NULL) AS t, COUNT(DISTINCT x) = 2 AND MIN(x) = 0 AND MAX(x) = 1 AND LEAST(SUM(y) FILTER (x = 0), SUM(y) FILTER (x = 1)) <= 0 AS empty_side,
    COUNT(*) FILTER (x IS NOT NULL AND is_own) AS n_own, COUNT(*) FILTER (x IS NOT NULL AND NOT is_own) AS n_competitor FROM f GROUP BY 1, 2),
  g AS (SELECT *, CASE WHEN n = 0 THEN 'all_na_prefilter' WHEN lv = 1 THEN 'constant_prefilter' WHEN n < 3 THEN 'insufficient_rows' WHEN t <= 0 OR empty_side THEN 'glm_error' END AS drop_reason FROM k),
  ok AS (SELECT product_line_id, predictor, x, y, e FROM f JOIN g USING (product_line_id, predictor) WHERE drop_reason IS NULL),
  {newton_sql('ok', 'po')}, {negbin_sql('ok', 'po', 'nb')},
  mk AS (SELECT g.*, CASE WHEN drop_reason IS NULL THEN 'estimated' WHEN drop_reason LIKE '%prefilter' THEN 'dropped' ELSE 'not_estimable' END AS estimation_status, spread, dispersion > {market.OVERDISPERSED} AS wild,
      CASE WHEN wild THEN theta END AS theta, CASE WHEN wild THEN nb.coefficient ELSE po.coefficient END AS coefficient, CASE WHEN wild THEN nb.std_error ELSE po.std_error * SQRT(dispersion) END AS std_error,
      CASE WHEN wild THEN nb.p_value ELSE {normal_tail_sql('(po.coefficient / (po.std_error * SQRT(dispersion)))')} END AS p_value
    FROM g LEFT JOIN po USING (product_line_id, predictor) LEFT JOIN nb USING (product_line_id, predictor))"""


@query(
    "market_model",
    "MKT2 MKT3",
    MARKET_SQL + """ SELECT product_line_id, predictor, 'product_attribute' AS predictor_type, CASE WHEN predictor NOT LIKE 'brand::%' THEN '5尺度' END AS scale, CASE WHEN predictor LIKE 'brand::%' THEN 'product_feature' ELSE 'rating' END AS attr_kind,
      estimation_status, drop_reason, CASE WHEN wild THEN 'negative_binomial' WHEN estimation_status = 'estimated' THEN 'quasipoisson' END AS family_used, n AS sample_size, n_own, n_competitor, n_competitor > 0 AS competitor_included,
      ROUND(theta, 4) AS theta, ROUND(coefficient, 6) AS coefficient, ROUND(std_error, 6) AS std_error, ROUND(p_value, 6) AS p_value, ROUND(EXP(coefficient * spread), 5) AS irr_display FROM mk""",
)
def market_model(spark, sf):
    out = market.label_attributes(_market(spark, sf), _scales(spark, sf))
    return out.select(
        *poisson.MODEL, "predictor_type", "scale", "attr_kind", "estimation_status", "drop_reason", "family_used", "sample_size", "n_own", "n_competitor", "competitor_included", F.round("theta", 4).alias("theta"),
        *[F.round(c, d).alias(c) for c, d in MARKET_DIGITS.items()],
    )


@query(
    "market_brand_effects",
    "MKT2",
    BRAND_SUMS_SQL + """
      SELECT product_line_id, 'brand::' || p_brand AS predictor, ROUND(LN((bt.y / bt.e) / ((lt.y - bt.y) / (lt.e - bt.e))), 6) AS coefficient FROM bt JOIN lt USING (product_line_id)""",
)
def brand_effects(spark, sf):
    quasi = _market(spark, sf, float("inf"))
    return quasi.filter(F.col("predictor").startswith("brand::")).select(*poisson.MODEL, F.round("coefficient", 6).alias("coefficient"))


# the limit at which the brand models of the given tables fall on both sides
FAMILY_LIMIT = 190.0


@query(
    "market_families",
    "MKT2",
    BRAND_SUMS_SQL + f""", r AS (SELECT it.product_line_id, b.p_brand, it.y, it.e * CASE WHEN it.p_brand = b.p_brand THEN b.y1 / b.e1 ELSE (lt.y - b.y1) / (lt.e - b.e1) END AS mu
        FROM it JOIN lt USING (product_line_id) JOIN (SELECT product_line_id, p_brand, y AS y1, e AS e1 FROM bt) b ON b.product_line_id = it.product_line_id),
      d AS (SELECT product_line_id, p_brand, COUNT(*) AS sample_size, SUM((y - mu) * (y - mu) / mu) / (COUNT(*) - 2) AS phi FROM r GROUP BY 1, 2)
      SELECT product_line_id, 'brand::' || p_brand AS predictor, sample_size, ROUND(phi, 5) AS dispersion, CASE WHEN phi > {FAMILY_LIMIT} THEN 'negative_binomial' ELSE 'quasipoisson' END AS family_used FROM d""",
)
def families(spark, sf):
    found = _market(spark, sf, FAMILY_LIMIT).filter(F.col("predictor").startswith("brand::"))
    return found.select(*poisson.MODEL, "sample_size", F.round("dispersion", 5).alias("dispersion"), "family_used")


@query(
    "market_attribute_coverage",
    "MKT4",
    MARKET_SQL + """, d AS (SELECT DISTINCT p_type AS product_line_id, UNNEST(['comfort', 'durability', 'fit', 'price_value', 'safety', 'colour', 'name', 'supplier_note']) AS predictor FROM part)
      SELECT product_line_id, predictor, CASE WHEN predictor = 'supplier_note' THEN 'source_table_not_consumed' WHEN predictor = 'name' THEN 'non_numeric' WHEN predictor = 'colour' THEN 'topic_not_rated'
        WHEN estimation_status IS DISTINCT FROM 'estimated' THEN 'not_estimable' WHEN p_value < 0.05 THEN 'significant' ELSE 'not_significant' END AS fate FROM d LEFT JOIN mk USING (product_line_id, predictor)""",
)
def attribute_coverage(spark, sf):
    t = _properties(spark, sf).select("product_line_id", F.col("topic").alias("predictor"), F.lit(True).alias("consumed"), F.lit(True).alias("is_numeric"), (F.col("topic") != "colour").alias("is_rated"))
    p = products(spark, sf).select("product_line_id").distinct()
    extra = p.select("product_line_id", F.explode(F.array(F.lit("name"), F.lit("supplier_note"))).alias("predictor")).select(
        "*", (F.col("predictor") == "name").alias("consumed"), F.lit(False).alias("is_numeric"), F.lit(True).alias("is_rated")
    )
    return market.attribute_coverage(t.unionByName(extra), _market(spark, sf))


@query(
    "item_ownership",
    "MKT5",
    S + """, flags AS (SELECT p_partkey, p_size % 2 = 0 AS f FROM part WHERE p_size < 30), own AS (SELECT DISTINCT product_id FROM sales WHERE platform_id = 'amz' AND is_own)
      SELECT p_partkey AS product_id, COALESCE(f, own.product_id IS NOT NULL) AS is_own FROM part LEFT JOIN flags USING (p_partkey) LEFT JOIN own ON own.product_id = p_partkey""",
)
def owned(spark, sf):
    p = products(spark, sf)
    flags = p.filter("size < 30").select("product_id", (F.col("size") % 2 == 0).alias("is_own"))
    own = sales(spark, sf).filter("platform_id = 'amz' and is_own")
    return market.ownership(p.select("product_id"), "product_id", flags, own)


@query("market_drivers", "MKT6", MARKET_SQL + " SELECT product_line_id, predictor, ROUND(coefficient, 6) AS coefficient FROM mk WHERE estimation_status = 'estimated' AND p_value < 0.05")
def market_drivers(spark, sf):
    return market.drivers(_market(spark, sf)).select(*poisson.MODEL, F.round("coefficient", 6).alias("coefficient"))


@query("market_lines_without_data", "MKT7", "SELECT DISTINCT p_type AS product_line_id, '__no_market_data__' AS predictor, 'no_position_rows' AS drop_reason FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_type < 'M') UNION ALL SELECT DISTINCT p_type, 'size', NULL FROM part WHERE p_type < 'M'")
def no_market(spark, sf):
    p = products(spark, sf)
    some = p.filter("product_line_id < 'M'").select("product_line_id", F.lit("size").alias("predictor"), F.lit(None).cast("string").alias("drop_reason")).distinct()
    return market.market_sentinel(p, some).select("product_line_id", "predictor", "drop_reason")


# Lines by what they lack: PROMO has no items, ECONOMY no item ids, LARGE no numbers, MEDIUM no sales, SMALL no model although nothing lacks.
@query(
    "market_reasons",
    "MKT7",
    """SELECT DISTINCT p_type AS product_line_id, CASE p_type WHEN 'STANDARD' THEN 'size' ELSE '__no_market_data__' END AS predictor,
      CASE p_type WHEN 'PROMO' THEN 'no_product_profile' WHEN 'ECONOMY' THEN 'profile_no_item_id' WHEN 'LARGE' THEN 'no_numeric_attrs' WHEN 'MEDIUM' THEN 'no_sales' WHEN 'SMALL' THEN 'no_position_rows' END AS drop_reason FROM part""",
)
def reasons(spark, sf):
    line = F.col("product_line_id")
    own, comp = _totals(spark, sf)
    p = products(spark, sf).join(own.unionByName(comp), "product_id", "left")
    items = p.filter(line != "PROMO").select(
        "product_line_id", F.when(line != "ECONOMY", F.col("product_id")).alias("product_id"), F.when(line != "MEDIUM", F.coalesce("sales", F.lit(0.0))).alias("sales")
    )
    attributes = p.select("product_line_id", F.lit("size").alias("predictor"), F.when(line != "LARGE", F.col("size").cast("double")).alias("x"))
    some = p.filter(line == "STANDARD").select("product_line_id", F.lit("size").alias("predictor"), F.lit(None).cast("string").alias("drop_reason")).distinct()
    found = market.market_sentinel(p, some, reasons=market.market_reasons(p, items, attributes))
    return found.select("product_line_id", "predictor", "drop_reason")


# ---- recommendations -------------------------------------------------------------------------

STEP_SQL = """st AS (SELECT customer_id, product_id, payment_time, LEAD(product_id) OVER (PARTITION BY customer_id ORDER BY payment_time, order_id, line_number, product_id) AS nx FROM sales),
tr AS (SELECT product_id AS from_product, nx AS to_product, COUNT(*) AS n FROM st WHERE nx IS NOT NULL AND nx <> product_id GROUP BY 1, 2)"""


@query("purchase_next_pairs", "WIN13", S + f", {STEP_SQL} SELECT customer_id, COUNT(*) AS purchases, COUNT(nx) AS followed, CAST(SUM(nx) AS BIGINT) AS next_sum FROM st GROUP BY 1")
def next_pairs(spark, sf):
    steps = recommend.purchase_steps(order_lines(spark, sf))
    return steps.groupBy("customer_id").agg(F.count(F.lit(1)).alias("purchases"), F.count("next_product_id").alias("followed"), F.sum("next_product_id").alias("next_sum"))


@query("product_transitions", "REC1 WIN13", S + f", {STEP_SQL} SELECT from_product, to_product, n, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY from_product) AS probability FROM tr")
def transitions(spark, sf):
    return recommend.transitions(order_lines(spark, sf))


def _brand_steps(spark, sf):
    """The same purchases on brand level, where transitions repeat often."""
    p = products(spark, sf).select("product_id", F.regexp_extract("brand", r"(\d+)", 1).cast("long").alias("brand_no"))
    return order_lines(spark, sf).join(p, "product_id").drop("product_id").withColumnRenamed("brand_no", "product_id")


CHAIN_SQL = (
    S
    + """, b AS (SELECT customer_id, payment_time, order_id, line_number, CAST(REGEXP_EXTRACT(brand, '(\\d+)', 1) AS BIGINT) AS product_id FROM sales),
st AS (SELECT product_id, LEAD(product_id) OVER (PARTITION BY customer_id ORDER BY payment_time, order_id, line_number, product_id) AS nx FROM b),
tr AS (SELECT product_id AS f, nx AS t, COUNT(*) AS n FROM st WHERE nx IS NOT NULL AND nx <> product_id GROUP BY 1, 2),
c1 AS (SELECT DISTINCT product_id, [product_id] AS chain FROM b)"""
    + "".join(
        f""", c{i} AS (SELECT product_id, LIST_APPEND(ANY_VALUE(chain), ARG_MIN(t, (-n, t))) AS chain FROM (SELECT c.product_id, c.chain, tr.t, tr.n FROM c{i - 1} c JOIN tr ON tr.f = c.chain[{i - 1}] WHERE NOT LIST_CONTAINS(c.chain, tr.t)) GROUP BY 1)"""
        for i in range(2, 6)
    )
    + " SELECT product_id, chain, CAST(LEN(chain) AS INTEGER) AS length FROM c5"
)


@query("recommendation_chains", "REC3", CHAIN_SQL.replace("SELECT product_id, chain,", "SELECT product_id, ARRAY_TO_STRING(chain, '>') AS chain,"))
def chains(spark, sf):
    steps = _brand_steps(spark, sf)
    c = recommend.rec_chain(steps.select("product_id"), recommend.transitions(steps))
    return c.withColumn("chain", F.array_join(F.transform("chain", lambda x: x.cast("string")), ">"))


def _choices(spark, sf):
    return recommend.states_and_transitions(order_lines(spark, sf), "lineproduct_price")


@query("first_recommendations", "REC2")
def first(spark, sf):
    return recommend.first_rec(*_choices(spark, sf))


@query("product_recommendations", "REC1 REC2 REC3")
def recommended(spark, sf):
    return recommend.product_recommendations(*_choices(spark, sf))


# ---- segments --------------------------------------------------------------------------------


def _segments(spark, sf):
    ratings = materialise(_chained(spark, sf), "ratings")
    own, comp = _totals(spark, sf)
    pos = position.position(ratings, TOPICS, own, comp, products(spark, sf))
    return ratings, segments.segment_market(pos, TOPICS)


@query("market_segments", "SEG1")
def market_segments(spark, sf):
    return _segments(spark, sf)[1]


# whatever the starts: every item is in one cluster, no centre of its line is nearer, and clusters go by size
@query(
    "segment_invariants",
    "SEG1",
    "SELECT p_type AS product_line_id, COUNT(*) AS items, 3 AS clusters, 0 AS misplaced, TRUE AS by_size FROM part GROUP BY 1",
)
def segment_invariants(spark, sf):
    ratings, assigned = _segments(spark, sf)
    assigned = materialise(assigned, "assigned")
    stats = ratings.groupBy("product_line_id", "topic").agg(F.avg("rating").alias("_m"), F.stddev("rating").alias("_s"))
    z = ratings.join(stats, ["product_line_id", "topic"]).select("product_line_id", "product_id", "topic", F.when(F.col("_s") > 0, (F.col("rating") - F.col("_m")) / F.col("_s")).otherwise(0.0).alias("z"))
    z = materialise(z.join(assigned, ["product_line_id", "product_id"]), "scores")
    centres = z.groupBy("product_line_id", "cluster", "topic").agg(F.avg("z").alias("_c"))
    far = z.join(centres.withColumnRenamed("cluster", "other"), ["product_line_id", "topic"])
    far = far.groupBy("product_line_id", "product_id", "cluster", "other").agg(F.sum((F.col("z") - F.col("_c")) * (F.col("z") - F.col("_c"))).alias("d"))
    own = far.groupBy("product_line_id", "product_id").agg(F.min("d").alias("least"), F.max(F.when(F.col("other") == F.col("cluster"), F.col("d"))).alias("own"))
    wrong = own.groupBy("product_line_id").agg(F.count_if(F.col("own") > F.col("least") + 1e-4).cast("int").alias("misplaced"))
    sizes = assigned.groupBy("product_line_id", "cluster").agg(F.count(F.lit(1)).alias("n"))
    listed = sizes.groupBy("product_line_id").agg(F.sum("n").alias("items"), F.count(F.lit(1)).cast("int").alias("clusters"), F.array_sort(F.collect_list(F.struct("cluster", "n"))).alias("_by"))
    counts = F.transform("_by", lambda c: c["n"])
    ordered = listed.withColumn("by_size", counts == F.reverse(F.array_sort(counts))).drop("_by")
    return ordered.join(wrong, "product_line_id")


@query("segment_profiles", "SEG2")
def segment_profiles(spark, sf):
    ratings, assigned = _segments(spark, sf)
    out = segments.cluster_profile(assigned, ratings)
    return out.select("product_line_id", "cluster", "topic", F.round("cluster_mean", 6).alias("cluster_mean"), F.round("deviation", 6).alias("deviation"))


@query(
    "size_band_profiles",
    "SEG2",
    RT + """, i AS (SELECT product_line_id, product_id, topic, AVG(rating) AS rating FROM ratings GROUP BY 1, 2, 3), j AS (SELECT i.*, CAST(p_size % 3 AS INTEGER) AS cluster FROM i JOIN part ON p_partkey = product_id WHERE rating IS NOT NULL),
      l AS (SELECT product_line_id, topic, AVG(rating) AS m, STDDEV_SAMP(rating) AS s FROM j GROUP BY 1, 2), c AS (SELECT product_line_id, cluster, topic, AVG(rating) AS cm FROM j GROUP BY 1, 2, 3)
      SELECT product_line_id, cluster, topic, ROUND(cm, 6) AS cluster_mean, ROUND((cm - m) / s, 6) AS deviation FROM c JOIN l USING (product_line_id, topic)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY product_line_id, cluster ORDER BY ABS((cm - m) / s) DESC, topic) <= 5""",
)
def band_profiles(spark, sf):
    bands = products(spark, sf).select("product_line_id", "product_id", (F.col("size") % 3).alias("cluster"))
    out = segments.cluster_profile(bands, rev.ratings_by_item(ratings_long(spark, sf)))
    return out.select("product_line_id", "cluster", "topic", F.round("cluster_mean", 6).alias("cluster_mean"), F.round("deviation", 6).alias("deviation"))


@query(
    "analysis_scope",
    "SEG3",
    S + """ SELECT DISTINCT product_line_id, 'customers' AS analysis FROM sales UNION ALL SELECT DISTINCT product_line_id, 'position' FROM (SELECT CASE WHEN size = 1 THEN 'UNKNOWN' ELSE product_line_id END AS product_line_id FROM sales) WHERE product_line_id <> 'UNKNOWN'""",
)
def analysis_scope(spark, sf):
    s = sales(spark, sf)
    placed = s.withColumn("product_line_id", F.when(F.col("size") == 1, "UNKNOWN").otherwise(F.col("product_line_id")))
    return segments.scope({"customers": s, "position": placed})


@query(
    "changed_brand_cells",
    "SEG4 FN21",
    """SELECT p_type, p_brand, CASE WHEN MIN(p_size) > 3 THEN 'never' WHEN COUNT(*) FILTER (p_size <= 3) = COUNT(*) THEN 'new' ELSE 'changed' END AS state FROM part GROUP BY 1, 2 HAVING MIN(p_size) <= 3""",
)
def changed(spark, sf):
    p = table(spark, sf, "part")
    cell, cols = ["p_type", "p_brand"], ["p_partkey", "p_name", "p_size"]
    return segments.changed_cells(fingerprint(p, cell, cols), fingerprint(p.filter("p_size > 3"), cell, cols), cell)


# ---- products --------------------------------------------------------------------------------


@query("line_dictionary", "PRD1 SRC10", f"SELECT p_partkey AS product_id, p_type AS product_line_id FROM part")
def line_dictionary(spark, sf):
    return prod.line_dictionary(products(spark, sf))


MAPPING_SQL = """src AS (SELECT 'S' || p_partkey % 700 AS sku, CAST(p_partkey % 90 AS VARCHAR) AS item_id, p_type AS product_line_id, 1 AS source_rank FROM part WHERE p_size < 10
  UNION ALL SELECT 'S' || p_partkey % 700, CAST(p_partkey % 90 AS VARCHAR), p_type, 2 FROM part WHERE p_size < 25 UNION ALL SELECT 'S' || p_partkey % 700, CAST(p_partkey % 90 AS VARCHAR), p_type, 3 FROM part),
best AS (SELECT * FROM src QUALIFY ROW_NUMBER() OVER (PARTITION BY sku, item_id ORDER BY source_rank, product_line_id) = 1)"""


@query("product_mapping", "PRD2 SET1 WIN2 WIN4", f"WITH {MAPPING_SQL} SELECT *, ROW_NUMBER() OVER (ORDER BY sku, item_id) AS mapping_id FROM best")
def product_mapping(spark, sf):
    p = products(spark, sf).select(
        F.concat(F.lit("S"), (F.col("product_id") % 700).cast("string")).alias("sku"), (F.col("product_id") % 90).cast("string").alias("item_id"), "product_line_id", "size"
    )
    return prod.product_mapping([p.filter("size < 10"), p.filter("size < 25"), p])


@query("catalogue_master", "PRD3 WIN10", S + " SELECT product_id AS item_id, platform_id AS marketplace, product_line_id, MIN(order_id) AS first_order FROM sales GROUP BY 1, 2, 3")
def catalogue(spark, sf):
    s = sales(spark, sf).select(F.col("product_id").alias("item_id"), F.col("platform_id").alias("marketplace"), "product_line_id", F.col("order_id").alias("first_order"))
    return prod.catalogue(s)


@query(
    "property_dictionary",
    "PRD5 SRC5",
    """SELECT p_type AS product_line_id, p_brand AS property_id, MIN(p_name) AS property_name, MIN(p_name) AS property_name_english, 'attribute' AS type, '5' AS scale FROM part GROUP BY 1, 2""",
)
def property_dictionary(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_type").alias("product_line_id"), F.col("p_brand").alias("property_id"), F.col("p_name").alias("property_name"),
        F.lit(" ").alias("property_name_english"), F.lit("attribute").alias("類型"), F.lit("5").alias("尺度"),
    )
    return prod.property_dict(raw).drop("definition")


@query(
    "property_lookup_keys",
    "PRD6",
    "SELECT p_partkey AS product_id, p_type || '|' || p_brand AS property_lookup_key, p_partkey || '|' || p_brand AS product_property_key, p_brand || '|2024-01-01' AS temporal_key FROM part",
)
def property_keys(spark, sf):
    p = products(spark, sf).select("product_id", "product_line_id", F.col("brand").alias("property_id"), F.lit("2024-01-01").alias("load_date"))
    return prod.lookup_keys(p, "load_date").drop("product_line_id", "property_id", "load_date")


@query("competitor_ranks", "PRD6", S + ", t AS (SELECT product_line_id, product_id, SUM(quantity) AS sales FROM sales WHERE NOT is_own GROUP BY 1, 2) SELECT *, DENSE_RANK() OVER (PARTITION BY product_line_id ORDER BY sales DESC) AS competitor_rank FROM t")
def competitor_ranks(spark, sf):
    t = sales(spark, sf).filter("not is_own").groupBy("product_line_id", "product_id").agg(F.sum("quantity").alias("sales"))
    return prod.competitor_rank(t)


@query("line_dimension", "PRD7", "SELECT p_type AS product_line_id, LOWER(p_type) AS name_en, COUNT(*) AS items FROM part GROUP BY 1, 2")
def line_dimension(spark, sf):
    raw = products(spark, sf).groupBy(F.concat(F.lit(" "), "product_line_id").alias(" product_line_id")).agg(F.count(F.lit(1)).alias("items"))
    raw = raw.withColumn("name_en ", F.lower(F.col(" product_line_id")))
    return prod.line_dim(raw)


@query("attribute_metadata", "PRD8", "SELECT DISTINCT p_brand AS attribute_id, CAST(NULL AS VARCHAR) AS name_zh, LOWER(p_brand) AS name_en, CAST(NULL AS VARCHAR) AS category, 'nominal' AS scale_type FROM part WHERE p_brand <> 'Brand#7'")
def attribute_metadata(spark, sf):
    brand = F.when(F.col("p_brand") == "Brand#7", " ").otherwise(F.concat(F.col("p_brand"), F.lit(" ")))
    raw = table(spark, sf, "part").select(brand.alias("attribute_id"), F.lower("p_brand").alias("name_en"), F.lit("nominal").alias("scale_type")).distinct()
    return prod.attribute_meta(raw)
