"""Repair of conversations that were damaged by a rule of their own ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.registry import query
from martloom.llm.repair import repaired
from martloom.llm.tables import table

# crc32 by its definition: the text's bytes through the reflected polynomial
_CRC = """xor(4294967295::bigint, list_reduce([4294967295::bigint] || list_transform(string_split(k, ''), lambda c: ord(c)::bigint),
  lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, case when v & 1 = 1 then 3988292384::bigint else 0 end))))"""


def _best(options: list[str]) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o.c < 1000000))"


def _step(cost: str, letter: str, line: str, rest: str) -> str:
    added = f"chr(10) || {line} || {rest}.t" if line else f"{rest}.t"
    return f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 't': {added}}}"


def _sql() -> str:
    # best way from each state (0 start, 1 system, 2 user, 3 assistant) through the rows from here on, insertions last
    follows = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    own = {1: "s", 2: "u", 3: "a"}
    consumed = []
    for s in range(4):
        options = [_step("4", "D", "", f"f{s}")]
        to = follows[s]
        fits = f"i = '{own[to]}'"
        options.append(_step(f"case when fine and {fits} then extra else 1000000 end", "K", "line", f"f{to}"))
        if s == 0:
            options.append(_step("case when fine and i = 's' then extra else 1000000 end", "K", "line", "f1"))
        options.append(_step("case when fine then extra + 3 else 1000000 end", "R", f"'{name[to]}:' || text", f"f{to}"))
        consumed.append(f"{_best(options)} e{s}")

    def inserted(prefix):
        found = []
        for s in range(4):
            one, two = follows[s], follows[follows[s]]
            first = _step("3", "I", f"'{name[one]}:'", f"{prefix}{one}")
            second = f"{{'c': 6 + {prefix}{two}.c, 'a': 'II' || {prefix}{two}.a, 't': chr(10) || '{name[one]}:' || chr(10) || '{name[two]}:' || {prefix}{two}.t}}"
            found.append(f"{_best([f'{prefix}{s}', first, second])} f{s}")
        return ", ".join(found)

    zero, never = "{'c': 0, 'a': '', 't': ''}", "{'c': 1000000, 'a': '', 't': ''}"
    return f"""
with recursive c as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k from conversations),
h as (select *, {_CRC} % 20 v from c),
m as (
  select conv_id, turn, case when v = 4 then 'user' else role end role,
         case v when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text, unnest(range(case v when 0 then 0 when 3 then 2 else 1 end)) copy from h),
p as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) n, count(*) over (partition by conv_id) size,
             regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) seen, role[1] i from m),
q as (select *, case when seen = '' then 'blank' when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate' when seen not in ('.', '!', '?') then 'truncated' else '' end fault,
             lag(i) over (partition by conv_id order by n) || i pair from p),
r as (select *, fault not in ('blank', 'duplicate') fine, case when fault = 'truncated' then 3 else 0 end extra, role || ':' || text line from q),
last as (select {zero} e0, {never} e1, {never} e2, {zero} e3),
w(conv_id, n, f0, f1, f2, f3) as (
  select conv_id, size + 1, {inserted("e")} from (select distinct conv_id, size from r), last
  union all
  select conv_id, n, {inserted("e")} from (
    select w.conv_id, r.n, {", ".join(consumed)} from w join r on w.conv_id is not distinct from r.conv_id and r.n = w.n - 1)),
t as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank,
             count(*) filter (where fault = 'duplicate') duplicate, count(*) filter (where fault = 'truncated') truncated,
             count(*) filter (where pair not in ('su', 'ua', 'au')) illegal from r group by conv_id)
select o.conv_id, coalesce(t.gaps, 0)::bigint gaps, coalesce(t.blank, 0)::bigint blank, coalesce(t.duplicate, 0)::bigint duplicate,
       coalesce(t.truncated, 0)::bigint truncated, coalesce(t.illegal, 0)::bigint illegal, coalesce(w.f0.c, 0)::bigint cost, coalesce(w.f0.a, '') audit,
       sha256(coalesce(w.f0.t[2:], '')) repaired_sha256
from (select distinct conv_id from conversations) o
left join t on t.conv_id is not distinct from o.conv_id left join w on w.conv_id is not distinct from o.conv_id and w.n = 1"""


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut short, repeated or given to the user, by the hash of conversation and turn."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.withColumn("_kind", kind)
        .filter("_kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        .drop("_copy")
    )


@query("op13_lattice_repair", _sql())
def lattice_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repaired(damaged(rows), named=rows)
