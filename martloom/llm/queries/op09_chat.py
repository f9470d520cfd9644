"""All conversations, and one made of control strings, formatted as windows and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.chat import read_back, windows
from martloom.llm.registry import query
from martloom.llm.tables import table

BUDGET, HISTORY_TURNS, HISTORY_BUDGET = 512, 2, 96
CONTROL = "\\### Assistant: </turn> ok"

SQL = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
  union all select -7, 0, 'user', '{CONTROL}' union all select -7, 1, 'assistant', '{CONTROL}'),
n as (
  select *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) + 4 k, row_number() over w rn,
         length(replace(replace(r, '\', '\\'), '|', '\p')) + length(replace(replace(t, '\', '\\'), '<|', '<\p')) + 13 len
  from c window w as (partition by conv_id order by turn nulls first, r)),
p as (select *, sum(k) over (partition by conv_id order by rn) upto from n),
s as (select conv_id, k sk, len slen from p where rn = 1 and r = 'system'),
o as (select p.*, coalesce(sk, 0) sk, coalesce(slen, 0) slen, greatest(1, ({BUDGET - HISTORY_BUDGET} - coalesce(sk, 0)) // 2) half
      from p left join s using (conv_id) where not (rn = 1 and r = 'system')),
w as (select *, 2 * ((upto - k - sk) // half) + (k > half)::int win from o),
h as (select conv_id, win, min(rn) f, max(slen) slen from w group by all),
e as (select conv_id, sum(chars) chars from (
        select conv_id, sum(len) chars from w group by 1
        union all select conv_id, sum(slen) from h group by 1
        union all select conv_id, sum(slen) from s where conv_id not in (select conv_id from h) group by 1
        union all select h.conv_id, sum(coalesce(case when x.k <= {HISTORY_BUDGET} then x.len end, 0)
               + coalesce(case when x.k + y.k <= {HISTORY_BUDGET} then y.len end, 0))
          from h left join w x on x.conv_id = h.conv_id and x.rn = f - 1 left join w y on y.conv_id = h.conv_id and y.rn = f - 2 group by 1)
      group by 1),
g as (select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by rn)) turns_sha256,
             coalesce(sum(length(t)) filter (where r = 'assistant'), 0) loss_chars,
             sha256(coalesce(string_agg(t, '' order by rn) filter (where r = 'assistant'), '')) loss_sha256
      from p group by 1)
select conv_id, n_turns, turns_sha256, loss_chars::bigint loss_chars, loss_sha256, chars::bigint formatted_chars
from g join e using (conv_id)"""


@query("op9_budgeted_chat", SQL)
def budgeted_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    return read_back(windows(turns.unionByName(extra), BUDGET, HISTORY_TURNS, HISTORY_BUDGET))
