"""Secrets of every document, found through a blob ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.registry import query
from martloom.llm.secret_scan import BASE_RULES, scan_unseen, spans_text, with_findings
from martloom.llm.tables import table
from martloom.session import materialise


def _sql() -> str:
    parts = []
    for i, r in enumerate(BASE_RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  select doc_id, {i} k, '{r.name}' kind, {r.least} least, string_split_regex(t, '{pattern}') gaps,
         regexp_extract_all(t, '{pattern}', 0) whole, regexp_extract_all(t, '{pattern}', {r.group}) part
  from d where regexp_matches(t, '{pattern}')""")
    return f"""
with d as (select doc_id, coalesce(text, '') t from documents),
m as ({' union all '.join(parts)}),
e as (select doc_id, k, kind, least, unnest(range(1, len(whole) + 1)) i, gaps, whole, part from m),
s as (select doc_id, k, kind, length(whole[i]) size, length(part[i]) judged, least,
             list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(whole[1:i], lambda x: length(x))) stop from e),
f as (select doc_id, k, kind, stop - size start, stop from s where judged >= least),
g as (select doc_id, count(*) filter (where k = 0) a, count(*) filter (where k = 1) b, count(*) filter (where k = 2) c,
             string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, k) spans from f group by doc_id)
select doc_id, coalesce(a, 0)::bigint n_assign, coalesce(b, 0)::bigint n_access, coalesce(c, 0)::bigint n_hex,
       sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans
from d left join g using (doc_id)"""


@query("op2_blob_ledger_secrets", _sql())
def blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = materialise(scan_unseen(docs, "text", BASE_RULES), "ledger")
    found = with_findings(docs, "text", BASE_RULES, ledger)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["rule"] == kind)).cast("long")
    spans = spans_text(F.col("secrets"))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
    )
