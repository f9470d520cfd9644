"""The ten highest integer inner products of every hundredth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.nearest import top_products
from martloom.llm.registry import query
from martloom.llm.tables import table

SQL = """
with e as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)) v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id query_id, e.vec_id, list_dot_product(q.v, e.v)::bigint score from e q join e on e.vec_id <> q.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from p)
select query_id, rank::int rank, vec_id, score from r where rank <= 10"""


@query("op5_mtree_topk", SQL)
def mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=10)
