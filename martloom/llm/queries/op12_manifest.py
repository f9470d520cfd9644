"""Proofs of all documents against one Merkle root, some of them for rows that were tampered with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.merkle import leaf_of, proofs
from martloom.llm.registry import query
from martloom.llm.tables import table


def _field(column: str) -> str:
    text = f"cast({column} as varchar)"
    return f"coalesce(octet_length(encode({text}))::varchar || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# crc32 by its definition: the decimal text's bytes through the reflected polynomial
_CRC = """list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
  lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, case when v & 1 = 1 then 3988292384::bigint else 0 end)))"""

SQL = f"""
with recursive d as (
  select doc_id, lang, {_leaf("n_chars")} leaf, {_leaf("n_chars + 1")} other, xor({_CRC}, 4294967295::bigint) crc from documents),
l as (select *, case when crc % 7 = 0 then other else leaf end shown, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 pos,
             count(*) over (partition by lang) total from d),
tree(lang, level, pos, digest, total) as (
  select lang, 0, pos, leaf, total from l
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (max(total) + 1) // 2 from tree where total > 1 group by lang, level, pos // 2),
sub as (select lang, digest subroot, level height, row_number() over (order by lang nulls first) - 1 rank, count(*) over () groups from tree where total = 1),
top(level, pos, digest, total) as (
  select 0, rank, subroot, groups from sub
  union all
  select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (max(total) + 1) // 2 from top where total > 1 group by level, pos // 2),
root as (select digest root, level height from top where total = 1),
fold(doc_id, lang, leaf, pos, level, node, path) as (
  select doc_id, lang, leaf, pos, 0, shown, '' from l
  union all
  select f.doc_id, f.lang, f.leaf, f.pos // 2, f.level + 1,
         sha256(case when f.pos % 2 = 1 then t.digest || f.node else f.node || coalesce(t.digest, '') end), f.path || coalesce(t.digest, '')
  from fold f join sub s on f.lang is not distinct from s.lang and f.level < s.height
  left join tree t on t.lang is not distinct from f.lang and t.level = f.level and t.pos = xor(f.pos, 1)),
risen(doc_id, lang, leaf, pos, level, node, path) as (
  select f.doc_id, f.lang, f.leaf, s.rank, 0, f.node, f.path from fold f join sub s on f.lang is not distinct from s.lang and f.level = s.height
  union all
  select f.doc_id, f.lang, f.leaf, f.pos // 2, f.level + 1,
         sha256(case when f.pos % 2 = 1 then t.digest || f.node else f.node || coalesce(t.digest, '') end), f.path || coalesce(t.digest, '')
  from risen f join root r on f.level < r.height left join top t on t.level = f.level and t.pos = xor(f.pos, 1))
select f.doc_id, f.leaf, s.subroot, r.root, sha256(f.path) proof_sha256, f.node folded_root, f.node = r.root verified
from risen f join root r on f.level = r.height join sub s on f.lang is not distinct from s.lang"""


@query("op12_checkpointed_manifest", SQL)
def checkpointed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_chars = F.col("n_chars")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, n_chars + 1).otherwise(n_chars)
    row = lambda n: leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    leaves = docs.select("doc_id", "lang", row(n_chars).alias("leaf"), row(tampered).alias("shown"))
    found = proofs(leaves, "lang", ["doc_id"], "leaf", "shown", ["doc_id"])
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
