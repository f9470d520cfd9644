"""Canonical commerce views over the given star-schema tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


OWN_BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def platform_of(order_key: Column) -> Column:
    return F.when(order_key % 3 == 0, "amz").when(order_key % 3 == 1, "cbz").otherwise("eby")


def status_of(flag: Column) -> Column:
    return F.when(flag == "P", "pending").when(flag == "O", "shipped").otherwise("delivered")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order; no product attributes."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("payment_time"),
        F.to_date("o_orderdate").alias("order_date"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("gross_price"),
        F.col("l_discount").alias("discount_rate"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("lineproduct_price"),
        platform_of(F.col("l_orderkey")).alias("platform_id"),
        status_of(F.col("o_orderstatus")).alias("order_status"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_line_id"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail_price"),
        F.col("p_brand").isin(OWN_BRANDS).alias("is_own"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised sales lines: order, customer, product line, money."""
    lines = order_lines(spark, sf_dir)
    p = products(spark, sf_dir)
    return lines.join(p, "product_id")


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Latest order day as a literal (one row comes back)."""
    day = table(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("d")).first()["d"]
    return F.lit(day)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews derived from the documents: one per document."""
    d = table(spark, sf_dir, "documents")
    n_parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return d.select(
        F.col("doc_id").alias("review_id"),
        (F.col("doc_id") % n_parts).alias("product_id"),
        F.col("text").alias("review_body"),
        (1 + F.col("n_chars") % 5).cast("int").alias("rating"),
        F.when(F.col("source").isin("src0", "src1", "src2", "src3", "src4", "src5", "src6"), "amz")
        .when(F.col("source").isin("src7", "src8", "src9", "src10", "src11", "src12"), "cbz")
        .otherwise("eby")
        .alias("platform_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("doc_id") % 1500).cast("int")).alias("review_date"),
        F.col("lang"),
        F.col("n_chars"),
    )


# Topics a review can be rated on. Fixed values of the test mapping.
TOPICS = ["comfort", "durability", "fit", "price_value", "safety"]
BINARY_TOPICS = ["safety"]


def ratings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product line, item, review, topic, rating) with gaps: a fifth of the ratings is missing."""
    r = reviews(spark, sf_dir).drop("platform_id")
    p = products(spark, sf_dir).select("product_id", "product_line_id", "brand", "is_own")
    rated = F.array(
        *[
            F.struct(
                F.lit(t).alias("topic"),
                F.when((F.col("review_id") + i) % 5 != 0, ((F.col("n_chars") + i * F.col("rating")) % 6).cast("double")).alias("rating"),
            )
            for i, t in enumerate(TOPICS)
        ]
    )
    return (
        r.join(p, "product_id")
        .select("product_line_id", "product_id", "brand", "is_own", "review_id", "review_date", F.explode(rated).alias("t"))
        .select("product_line_id", "product_id", "brand", "is_own", "review_id", "review_date", "t.topic", "t.rating")
    )


PLATFORM_SQL = "CASE {k} % 3 WHEN 0 THEN 'amz' WHEN 1 THEN 'cbz' ELSE 'eby' END"
STATUS_SQL = "CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'shipped' ELSE 'delivered' END"

SALES_SQL = f"""sales AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS supplier_id,
         o_custkey AS customer_id, o_orderdate AS payment_time, CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS ship_date, l_quantity AS quantity, l_extendedprice AS gross_price,
         l_discount AS discount_rate, l_extendedprice * (1 - l_discount) AS lineproduct_price,
         {PLATFORM_SQL.format(k='l_orderkey')} AS platform_id, {STATUS_SQL} AS order_status,
         p_name AS product_name, p_brand AS brand, p_type AS product_line_id, p_size AS size, p_retailprice AS retail_price,
         p_brand IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5') AS is_own
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

REVIEWS_SQL = """reviews AS (
  SELECT doc_id AS review_id, doc_id % (SELECT COUNT(*) FROM part) AS product_id, text AS review_body,
         CAST(1 + n_chars % 5 AS INTEGER) AS rating,
         CASE WHEN source IN ('src0','src1','src2','src3','src4','src5','src6') THEN 'amz'
              WHEN source IN ('src7','src8','src9','src10','src11','src12') THEN 'cbz' ELSE 'eby' END AS platform_id,
         DATE '2000-01-01' + CAST(doc_id % 1500 AS INTEGER) AS review_date, lang, n_chars
  FROM documents)"""

RATINGS_SQL = (
    REVIEWS_SQL
    + """, topics AS (SELECT * FROM (VALUES (0,'comfort'),(1,'durability'),(2,'fit'),(3,'price_value'),(4,'safety')) t(i, topic)),
ratings AS (
  SELECT p_type AS product_line_id, r.product_id, p_brand AS brand,
         p_brand IN ('Brand#1','Brand#2','Brand#3','Brand#4','Brand#5') AS is_own, review_id, review_date, topic,
         CASE WHEN (review_id + i) % 5 <> 0 THEN CAST((n_chars + i * rating) % 6 AS DOUBLE) END AS rating
  FROM reviews r JOIN part ON p_partkey = r.product_id CROSS JOIN topics)"""
)


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def rmean(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE) / NULLIF(COUNT({x}), 0)"
