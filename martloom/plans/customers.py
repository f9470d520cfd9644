"""Registered customer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import customer as cus
from martloom.operators.lifetime import PARAMETERS, fit_lifetime
from martloom.plans.commerce import SALES_SQL, as_of, msum, rmean, sales, table
from martloom.plans.registry import query
from martloom.session import materialise

BY_DATE_SQL = (
    SALES_SQL
    + f""", cbd AS (
  SELECT platform_id, f AS product_line_id_filter, customer_id, order_date AS date,
         {msum('lineproduct_price')} AS sum_spent_by_date, COUNT(*) AS count_transactions_by_date, MIN(payment_time) AS min_time_by_date
  FROM (SELECT *, UNNEST([product_line_id, 'all']) AS f FROM sales) GROUP BY ALL)"""
)
BY_CUSTOMER_SQL = (
    BY_DATE_SQL
    + f""", bc AS (
  SELECT platform_id, product_line_id_filter, customer_id, {msum('sum_spent_by_date')} AS sum_sales_by_customer,
         CAST(SUM(count_transactions_by_date) AS BIGINT) AS sum_transactions_by_customer,
         CASE WHEN COUNT(*) > 1 THEN CAST(MAX(date) - MIN(date) AS DOUBLE) / (COUNT(*) - 1) END AS ipt, COUNT(*) AS ni,
         MIN(date) AS first_date, MAX(date) AS last_date
  FROM cbd GROUP BY ALL)"""
)
RFM_SQL = (
    BY_CUSTOMER_SQL
    + """, ref_day AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders), rfm AS (
  SELECT platform_id, product_line_id_filter, customer_id, CAST(d - last_date AS INTEGER) AS r_value, ni AS f_value,
         sum_sales_by_customer / ni AS m_value, ipt, CAST(d - first_date AS INTEGER) AS customer_tenure_days,
         sum_sales_by_customer AS total_spent
  FROM bc, ref_day)"""
)
SCOPE_SQL = "PARTITION BY platform_id, product_line_id_filter ORDER BY"
SCORES_SQL = (
    RFM_SQL
    + f""", scored AS (SELECT *, CAST(6 - NTILE(5) OVER ({SCOPE_SQL} r_value, customer_id) AS INTEGER) AS dna_r_score,
         CAST(NTILE(5) OVER ({SCOPE_SQL} f_value, customer_id) AS INTEGER) AS dna_f_score,
         CAST(NTILE(5) OVER ({SCOPE_SQL} m_value, customer_id) AS INTEGER) AS dna_m_score FROM rfm)"""
)
STATUS_CASE_SQL = """CASE WHEN r_value <= 2.0 * mean_cycle AND f_value = 1 THEN 'N' WHEN r_value <= 2.0 * mean_cycle THEN 'E0'
       WHEN r_value <= 2.5 * mean_cycle THEN 'S1' WHEN r_value <= 3.0 * mean_cycle THEN 'S2'
       WHEN mean_cycle IS NULL AND f_value = 1 THEN 'N' ELSE 'S3' END AS nes_status"""


def nes_sql(source: str) -> str:
    return f""", cycle AS (SELECT platform_id, product_line_id_filter, {rmean('ipt')} AS mean_cycle FROM {source} GROUP BY ALL),
nes AS (SELECT {source}.*, mean_cycle, {STATUS_CASE_SQL}
        FROM {source} JOIN cycle USING (platform_id, product_line_id_filter))"""


SEGMENT_SQL = (
    SCORES_SQL
    + nes_sql("scored")
    + f""", seg AS (SELECT *, nes_status || '_' || value_tier AS dna_segment FROM (
  SELECT *, CASE NTILE(3) OVER ({SCOPE_SQL} total_spent, customer_id) WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END AS value_tier FROM nes))"""
)
GAPS_SQL = """, gaps AS (
  SELECT platform_id, product_line_id_filter, customer_id, COUNT(t) AS n_gaps, SUM(t) AS sum_t, SUM(i * t) AS sum_it, SUM(t * t) AS sum_tt
  FROM (SELECT *, date - LAG(date) OVER w AS t, ROW_NUMBER() OVER w - 1 AS i FROM cbd
        WINDOW w AS (PARTITION BY platform_id, product_line_id_filter, customer_id ORDER BY date)) GROUP BY ALL),
act AS (
  SELECT platform_id, product_line_id_filter, customer_id, n_gaps,
         CASE WHEN n_gaps >= 1 THEN (CAST(sum_t AS DOUBLE) / n_gaps - CAST(sum_it AS DOUBLE) / (n_gaps * (n_gaps + 1) / 2.0))
              / (CAST(sum_t AS DOUBLE) / n_gaps) END AS cai,
         CASE WHEN n_gaps >= 2 THEN SQRT(GREATEST((sum_tt - CAST(sum_t * sum_t AS DOUBLE) / n_gaps) / (n_gaps - 1), 0.0))
              / (CAST(sum_t AS DOUBLE) / n_gaps) END AS gap_variation
  FROM gaps)"""
KEYS_SQL = "platform_id, product_line_id_filter, customer_id"


def _by_date(spark: SparkSession, sf: str) -> DataFrame:
    return cus.customer_by_date(sales(spark, sf))


def _rfm(spark: SparkSession, sf: str) -> DataFrame:
    return cus.rfm(cus.by_customer(_by_date(spark, sf)), as_of(spark, sf))


def _dna(spark: SparkSession, sf: str) -> DataFrame:
    return cus.customer_dna(_by_date(spark, sf), as_of(spark, sf))


@query(
    "customer_activity_flagship",
    "CUS2 CUS3 CUS4 CUS6 AGG15",
    "WITH " + RFM_SQL + nes_sql("rfm") + f" SELECT {KEYS_SQL}, r_value, f_value, m_value, nes_status FROM nes",
)
def flagship(spark, sf):
    return cus.nes_status(_rfm(spark, sf)).select(*cus.CUSTOMER, "r_value", "f_value", "m_value", "nes_status")


@query(
    "sales_input_gate",
    "CUS1",
    "WITH " + SALES_SQL + """ SELECT r.check_name AS "check", CASE WHEN r.ok THEN 'PASS' ELSE 'FAIL' END AS status, r.actual FROM (
      SELECT UNNEST([{'check_name':'row_count','ok':n>=1,'actual':n},{'check_name':'distinct_customers','ok':c>=1,'actual':c},
                     {'check_name':'foreign_platform','ok':x=0,'actual':x}]) AS r
      FROM (SELECT COUNT(*) n, COUNT(DISTINCT customer_id) c, COUNT(*) FILTER (platform_id NOT IN ('amz','cbz','eby')) x FROM sales))""",
)
def input_gate(spark, sf):
    return cus.check_sales(sales(spark, sf), ["amz", "cbz", "eby"])


@query("customer_by_date", "CUS2", "WITH " + BY_DATE_SQL + " SELECT * FROM cbd")
def by_date(spark, sf):
    return _by_date(spark, sf)


@query("customer_totals", "CUS3", "WITH " + BY_CUSTOMER_SQL + " SELECT * FROM bc")
def totals(spark, sf):
    return cus.by_customer(_by_date(spark, sf))


@query("customer_rfm", "CUS4", "WITH " + RFM_SQL + " SELECT * FROM rfm")
def rfm_table(spark, sf):
    return _rfm(spark, sf)


@query("customer_rfm_scores", "CUS5", "WITH " + SCORES_SQL + f" SELECT {KEYS_SQL}, dna_r_score, dna_f_score, dna_m_score FROM scored")
def scores(spark, sf):
    return cus.rfm_scores(_rfm(spark, sf)).select(*cus.CUSTOMER, "dna_r_score", "dna_f_score", "dna_m_score")


@query("customer_nes_status", "CUS6", "WITH " + RFM_SQL + nes_sql("rfm") + f" SELECT {KEYS_SQL}, ROUND(mean_cycle, 6) AS mean_cycle, nes_status FROM nes")
def status(spark, sf):
    return cus.nes_status(_rfm(spark, sf)).select(*cus.CUSTOMER, F.round("mean_cycle", 6).alias("mean_cycle"), "nes_status")


@query(
    "customer_activity_index",
    "CUS7",
    "WITH " + BY_DATE_SQL + GAPS_SQL + f" SELECT {KEYS_SQL}, n_gaps, ROUND(cai, 6) AS cai, ROUND(gap_variation, 6) AS gap_variation FROM act",
)
def activity(spark, sf):
    return cus.cai(_by_date(spark, sf)).select(*cus.CUSTOMER, "n_gaps", F.round("cai", 6).alias("cai"), F.round("gap_variation", 6).alias("gap_variation"))


@query(
    "customer_alive_probability",
    "CUS8",
    "WITH " + RFM_SQL + f""", b AS (SELECT {KEYS_SQL}, CAST(f_value - 1 AS DOUBLE) AS x, (customer_tenure_days - r_value) / 7.0 AS tx, customer_tenure_days / 7.0 AS age FROM rfm)
    SELECT {KEYS_SQL}, ROUND(1 / (1 + CASE WHEN x > 0 THEN 0.793 / (2.426 + x - 1) * POWER((4.414 + age) / (4.414 + tx), 0.243 + x) ELSE 0 END), 6) AS p_alive FROM b""",
)
def alive(spark, sf):
    return cus.p_alive_clv(_rfm(spark, sf)).select(*cus.CUSTOMER, F.round("p_alive", 6).alias("p_alive"))


# the series of the expected purchases, once for each (x, age): state [term, sum] over its first 700 terms
LIFETIME_SQL = (
    RFM_SQL
    + f""", b AS (SELECT {KEYS_SQL}, m_value, CAST(f_value - 1 AS DOUBLE) AS x, (customer_tenure_days - r_value) / 7.0 AS tx, customer_tenure_days / 7.0 AS age FROM rfm),
    z AS (SELECT DISTINCT x, age, 52.0 / (4.414 + age + 52.0) AS z FROM b),
    g AS (SELECT x, age, z, LIST_REDUCE([[1.0::DOUBLE, 1.0]] || LIST_TRANSFORM(RANGE(700), LAMBDA j: [j::DOUBLE, 0.0]), LAMBDA s, e:
      [s[1] * (1.976 + e[1]) * (-0.207 + e[1]) / (2.219 + x + e[1]) / (e[1] + 1) * z, s[2] + s[1] * (1.976 + e[1]) * (-0.207 + e[1]) / (2.219 + x + e[1]) / (e[1] + 1) * z])[2]
      * POWER(1 - z, 2.219 - 0.243 - 2.426 - x) AS series FROM z),
    v AS (SELECT b.*, (2.219 + x) / (0.793 - 1) * (1 - POWER((4.414 + age) / (4.414 + age + 52.0), 0.243 + x) * series)
      / (1 + CASE WHEN x > 0 THEN 0.793 / (2.426 + x - 1) * POWER((4.414 + age) / (4.414 + tx), 0.243 + x) ELSE 0 END) AS e FROM b JOIN g USING (x, age))"""
)


@query(
    "customer_lifetime_value",
    "CUS8",
    "WITH " + LIFETIME_SQL + f" SELECT {KEYS_SQL}, ROUND(e, 6) AS expected_purchases, ROUND(e * m_value, 2) AS clv FROM v",
)
def lifetime_value(spark, sf):
    scored = cus.p_alive_clv(_rfm(spark, sf))
    return scored.select(*cus.CUSTOMER, F.round("expected_purchases", 6).alias("expected_purchases"), F.round("clv", 2).alias("clv"))


@query("customer_lifetime_fit", "CUS8")
def lifetime_fit(spark, sf):
    found = fit_lifetime(_rfm(spark, sf), cus.SCOPE, penalty=0.001)
    return found.select(*cus.SCOPE, "customers", *[F.round(c, 4).alias(c) for c in (*PARAMETERS, "log_likelihood")], "fit_status")


@query("customer_lifetime_value_fitted", "CUS8")
def lifetime_value_fitted(spark, sf):
    scored = cus.fitted_clv(_rfm(spark, sf))
    return scored.select(*cus.CUSTOMER, F.round("p_alive", 4).alias("p_alive"), F.round("expected_purchases", 4).alias("expected_purchases"), F.round("clv", 2).alias("clv"), "fit_status")


@query(
    "customer_dna",
    "CUS9 CUS5 CUS6 CUS7 CUS11",
    "WITH " + SEGMENT_SQL + GAPS_SQL + f""" SELECT {KEYS_SQL}, r_value, f_value, m_value, dna_r_score, dna_f_score, dna_m_score,
      nes_status, value_tier, dna_segment, ROUND(cai, 6) AS cai FROM seg JOIN act USING ({KEYS_SQL})""",
)
def dna_table(spark, sf):
    return _dna(spark, sf).select(
        *cus.CUSTOMER, "r_value", "f_value", "m_value", "dna_r_score", "dna_f_score", "dna_m_score",
        "nes_status", "value_tier", "dna_segment", F.round("cai", 6).alias("cai"),
    )


def _named_sales(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    named = c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("buyer_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
    )
    return sales(spark, sf).join(named, "customer_id")


@query(
    "customer_profile",
    "CUS10",
    "WITH " + SALES_SQL + """ SELECT DISTINCT customer_id, platform_id, c_name AS buyer_name, LOWER(REPLACE(c_name, '#', '.')) || '@example.com' AS email
    FROM sales JOIN customer ON c_custkey = customer_id""",
)
def profile(spark, sf):
    return cus.customer_profile(_named_sales(spark, sf))


@query("customer_segments", "CUS11", "WITH " + SEGMENT_SQL + f" SELECT {KEYS_SQL}, value_tier, dna_segment FROM seg")
def segment_table(spark, sf):
    return cus.segments(cus.nes_status(_rfm(spark, sf))).select(*cus.CUSTOMER, "value_tier", "dna_segment")


@query(
    "customer_segment_statistics",
    "CUS12",
    "WITH " + SEGMENT_SQL + f""" SELECT platform_id, product_line_id_filter, dna_segment, COUNT(*) AS customers, ROUND({rmean('r_value')}, 4) AS avg_r,
      ROUND({rmean('f_value')}, 4) AS avg_f, ROUND({rmean('m_value')}, 2) AS avg_m,
      ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY platform_id, product_line_id_filter) AS DOUBLE), 6) AS share
      FROM seg GROUP BY platform_id, product_line_id_filter, dna_segment""",
)
def segment_statistics(spark, sf):
    seg = cus.segments(cus.nes_status(_rfm(spark, sf))).withColumn("cai", F.lit(None).cast("double"))
    prof = cus.customer_profile(_named_sales(spark, sf))
    v = cus.dna_views(seg, prof)["v_segment_statistics"]
    return v.select(*cus.SCOPE, "dna_segment", "customers", *[F.round(c, d).alias(c) for c, d in (("avg_r", 4), ("avg_f", 4), ("avg_m", 2), ("share", 6))])


DNA_SQL = SEGMENT_SQL + GAPS_SQL + ", dna AS (SELECT * FROM seg JOIN act USING (platform_id, product_line_id_filter, customer_id))"


def _views(spark, sf):
    return cus.dna_views(_dna(spark, sf), cus.customer_profile(_named_sales(spark, sf)))


@query(
    "customer_analytics_view",
    "CUS12",
    "WITH " + DNA_SQL + f""" SELECT {KEYS_SQL}, c_name AS buyer_name, LOWER(REPLACE(c_name, '#', '.')) || '@example.com' AS email, r_value, f_value, m_value, nes_status,
      dna_segment, ROUND(cai, 6) AS cai FROM dna JOIN customer ON c_custkey = customer_id""",
)
def analytics_view(spark, sf):
    v = _views(spark, sf)["v_customer_dna_analytics"]
    return v.select(*cus.CUSTOMER, "buyer_name", "email", "r_value", "f_value", "m_value", "nes_status", "dna_segment", F.round("cai", 6).alias("cai"))


@query("customer_segments_view", "CUS12", "WITH " + DNA_SQL + f" SELECT {KEYS_SQL}, nes_status, dna_segment, ROUND(cai, 6) AS cai, value_tier FROM dna")
def segments_view(spark, sf):
    v = _views(spark, sf)["v_customer_segments"]
    return v.select(*cus.CUSTOMER, "nes_status", "dna_segment", F.round("cai", 6).alias("cai"), "value_tier")


METRICS = ["r_value", "f_value", "m_value", "ipt"]
LONG_SQL = (
    RFM_SQL
    + """, long AS (SELECT platform_id, product_line_id_filter, metric, value FROM (
  SELECT platform_id, product_line_id_filter, UNNEST(['r_value','f_value','m_value','ipt']) AS metric,
         UNNEST([CAST(r_value AS DOUBLE), CAST(f_value AS DOUBLE), m_value, ipt]) AS value FROM rfm) WHERE value IS NOT NULL)"""
)


@query(
    "customer_metric_distribution",
    "CUS13",
    "WITH " + LONG_SQL + """, e AS (SELECT DISTINCT platform_id, product_line_id_filter, metric, value,
        COUNT(*) OVER (PARTITION BY platform_id, product_line_id_filter, metric ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        COUNT(*) OVER (PARTITION BY platform_id, product_line_id_filter, metric) AS size FROM long)
      SELECT platform_id, product_line_id_filter, metric, CAST(CEIL(CAST(upto * 500 AS DOUBLE) / size) AS INTEGER) AS bin, MAX(value) AS value,
             ROUND(MAX(CAST(upto AS DOUBLE) / size), 6) AS ecdf FROM e GROUP BY ALL""",
)
def metric_distribution(spark, sf):
    d = cus.distribution(_rfm(spark, sf), METRICS)
    return d.select(*cus.SCOPE, "metric", "bin", "value", F.round("ecdf", 6).alias("ecdf"))


@query(
    "customer_metric_histogram",
    "CUS13",
    "WITH " + LONG_SQL + """, s AS (SELECT *, MIN(value) OVER w AS lo, MAX(value) OVER w AS hi FROM long
        WINDOW w AS (PARTITION BY platform_id, product_line_id_filter, metric))
      SELECT platform_id, product_line_id_filter, metric,
        CAST(CASE WHEN hi > lo THEN LEAST(FLOOR((value - lo) / (hi - lo) * 30), 29) ELSE 0 END AS INTEGER) AS bin, COUNT(*) AS n FROM s GROUP BY ALL""",
)
def metric_histogram(spark, sf):
    return cus.histogram(_rfm(spark, sf), METRICS)


@query(
    "customer_category_counts",
    "CUS14",
    "WITH " + SEGMENT_SQL + """ SELECT platform_id, product_line_id_filter, category, label, COUNT(*) AS n FROM (
      SELECT platform_id, product_line_id_filter, UNNEST(['nes_status','dna_segment']) AS category, UNNEST([nes_status, dna_segment]) AS label FROM seg) GROUP BY ALL""",
)
def category_counts(spark, sf):
    return cus.category_counts(cus.segments(cus.nes_status(_rfm(spark, sf))), ["nes_status", "dna_segment"])


@query(
    "customer_summary_stats",
    "CUS14",
    "WITH " + LONG_SQL + f""" SELECT platform_id, product_line_id_filter, metric, COUNT(*) AS n, ROUND({rmean('value')}, 3) AS mean, ROUND(STDDEV_SAMP(value), 3) AS sd,
      ROUND(MIN(value), 3) AS min, ROUND(MAX(value), 3) AS max, ROUND(QUANTILE_CONT(value, 0.25), 3) AS p25, ROUND(QUANTILE_CONT(value, 0.5), 3) AS p50,
      ROUND(QUANTILE_CONT(value, 0.75), 3) AS p75 FROM long GROUP BY ALL""",
)
def summary(spark, sf):
    stats = cus.summary_stats(_rfm(spark, sf), METRICS)
    return stats.select(*cus.SCOPE, "metric", "n", *[F.round(c, 3).alias(c) for c in ("mean", "sd", "min", "max", "p25", "p50", "p75")])


@query(
    "customer_rsv_types",
    "CUS15",
    "WITH " + RFM_SQL + nes_sql("rfm") + GAPS_SQL + f""", t AS (SELECT {KEYS_SQL},
        NTILE(3) OVER ({SCOPE_SQL} r_value / mean_cycle, customer_id) AS r, NTILE(3) OVER ({SCOPE_SQL} COALESCE(gap_variation, 1e9), customer_id) AS s,
        NTILE(3) OVER ({SCOPE_SQL} m_value * f_value, customer_id) AS v FROM nes JOIN act USING ({KEYS_SQL}))
      SELECT {KEYS_SQL}, ['LowRisk','MidRisk','HighRisk'][r] || '-' || ['Stable','MidStable','Unstable'][s] || '-' || ['LowValue','MidValue','HighValue'][v] AS customer_type FROM t""",
)
def rsv_types(spark, sf):
    days = materialise(_by_date(spark, sf), "by_date")
    base = cus.nes_status(cus.rfm(cus.by_customer(days), as_of(spark, sf))).join(cus.cai(days), cus.CUSTOMER)
    return cus.rsv(base).select(*cus.CUSTOMER, "customer_type")


@query(
    "customer_cross_category",
    "CUS16",
    "WITH " + SALES_SQL + """, k AS (SELECT platform_id, customer_id, COUNT(DISTINCT product_line_id) AS k FROM sales GROUP BY ALL)
      SELECT platform_id, COUNT(*) AS customers, COUNT(*) FILTER (k = 1) AS one_line, COUNT(*) FILTER (k = 2) AS two_lines,
        COUNT(*) FILTER (k >= 3) AS three_or_more_lines, CAST(COUNT(*) FILTER (k >= 2) AS DOUBLE) / COUNT(*) AS cross_rate FROM k GROUP BY ALL""",
)
def cross(spark, sf):
    return cus.cross_category(_by_date(spark, sf))


SNAP_SQL = (
    BY_DATE_SQL
    + f""", ref_day AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders),
cuts AS (SELECT period, CAST(d - TO_MONTHS(m) AS DATE) AS cutoff FROM ref_day, (VALUES ('now',0),('month_ago',1),('quarter_ago',3),('year_ago',12)) p(period, m)),
base AS (SELECT period, cutoff, {KEYS_SQL}, COUNT(*) AS f_value, {msum('sum_spent_by_date')} / COUNT(*) AS m_value,
   CASE WHEN COUNT(*) > 1 THEN CAST(MAX(date) - MIN(date) AS DOUBLE) / (COUNT(*) - 1) END AS ipt, CAST(cutoff - MAX(date) AS INTEGER) AS r_value
   FROM cbd JOIN cuts ON date <= cutoff GROUP BY period, cutoff, platform_id, product_line_id_filter, customer_id),
cycle AS (SELECT period, platform_id, product_line_id_filter, {rmean('ipt')} AS mean_cycle FROM base GROUP BY ALL),
snap AS (SELECT base.*, {STATUS_CASE_SQL} FROM base JOIN cycle USING (period, platform_id, product_line_id_filter))"""
)


@query("customer_asof_snapshots", "CUS17", "WITH " + SNAP_SQL + f" SELECT period, cutoff, {KEYS_SQL}, r_value, f_value, m_value, nes_status FROM snap")
def snapshots(spark, sf):
    s = cus.dna_snapshots(_by_date(spark, sf), as_of(spark, sf))
    return s.select("period", "cutoff", *cus.CUSTOMER, "r_value", "f_value", "m_value", "nes_status")


@query(
    "customer_status_transitions",
    "CUS18",
    "WITH " + SNAP_SQL + """, steps AS (SELECT * FROM (VALUES ('month_ago','now'),('quarter_ago','month_ago'),('year_ago','quarter_ago')) s(from_period, to_period)),
    m AS (SELECT a.platform_id, a.product_line_id_filter, from_period, to_period, a.nes_status AS from_status, b.nes_status AS to_status, COUNT(*) AS customers
      FROM steps JOIN snap a ON a.period = from_period JOIN snap b ON b.period = to_period AND a.platform_id = b.platform_id
        AND a.product_line_id_filter = b.product_line_id_filter AND a.customer_id = b.customer_id GROUP BY ALL)
    SELECT *, ROUND(CAST(COALESCE(SUM(customers) FILTER (from_status IN ('S1','S2','S3') AND to_status = 'E0') OVER w, 0) AS DOUBLE)
       / NULLIF(SUM(customers) FILTER (from_status IN ('S1','S2','S3')) OVER w, 0), 6) AS awakening_rate FROM m
    WINDOW w AS (PARTITION BY platform_id, product_line_id_filter, from_period, to_period)""",
)
def transitions(spark, sf):
    t = cus.nes_transitions(cus.dna_snapshots(_by_date(spark, sf), as_of(spark, sf)))
    return t.withColumn("awakening_rate", F.round("awakening_rate", 6))


@query(
    "customer_snapshot_summary",
    "AGG17",
    "WITH " + RFM_SQL + nes_sql("rfm") + """, p AS (SELECT *, CAST(f_value - 1 AS DOUBLE) AS x, (customer_tenure_days - r_value) / 7.0 AS tx, customer_tenure_days / 7.0 AS age FROM nes),
      a AS (SELECT *, 1 / (1 + CASE WHEN x > 0 THEN 0.793 / (2.426 + x - 1) * POWER((4.414 + age) / (4.414 + tx), 0.243 + x) ELSE 0 END) AS p_alive FROM p)
      SELECT platform_id, product_line_id_filter, COUNT(*) AS n_customers, ROUND(AVG(p_alive), 4) AS mean_p_alive,
        ROUND(100.0 * COUNT(*) FILTER (nes_status = 'E0') / COUNT(*), 4) AS e0_pct, ROUND(100.0 * COUNT(*) FILTER (nes_status IN ('S1','S2','S3')) / COUNT(*), 4) AS sleeping_pct
      FROM a GROUP BY ALL""",
)
def snapshot_summary(spark, sf):
    dna = cus.p_alive_clv(cus.nes_status(_rfm(spark, sf)))
    s = cus.dna_snapshot_summary(dna)
    return s.select(*cus.SCOPE, "n_customers", *[F.round(c, 4).alias(c) for c in ("mean_p_alive", "e0_pct", "sleeping_pct")])
