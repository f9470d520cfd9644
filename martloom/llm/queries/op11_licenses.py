"""Licences of every document by the positional index of rare tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.license_index import SLACK, TEMPLATES, phrases_of, with_licenses
from martloom.llm.registry import query
from martloom.llm.tables import table


def _sql() -> str:
    phrases = phrases_of(TEMPLATES)
    starts = []
    for k, p in enumerate(phrases):
        n, text = len(p.words), "['" + "', '".join(p.words) + "']"
        starts.append(f"list_filter(places, lambda i: w[i] = '{p.words[0]}' and w[i:i + {n - 1}] = {text}) s{k}")
    score, names, bases = [], [], []
    for t, template in enumerate(TEMPLATES):
        own = [k for k, p in enumerate(phrases) if p.template == t]
        near = [f"len(list_filter(s{k}, lambda j: abs(j - i - {phrases[k].at - phrases[own[0]].at}) <= {SLACK})) > 0" for k in own[1:]]
        hit = f"len(list_filter(s{own[0]}, lambda i: {' and '.join(near) or 'true'})) > 0"
        names.append(f"case when {hit} then '{template.label}' end")
        if template.base:
            bases.append(names[-1])
        total = sum(len(phrases[k].words) for k in own)
        seen = " + ".join(f"case when len(s{k}) > 0 then {len(phrases[k].words)} else 0 end" for k in own)
        score.append(f"({seen})::double / {total}")
    base = [k for k, p in enumerate(phrases) if TEMPLATES[p.template].base]
    firsts = ", ".join(sorted({f"'{p.words[0]}'" for p in phrases}))
    places = " || ".join(f"s{k}" for k in base)
    return f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
r as (select doc_id, w, list_filter(range(1, len(w) + 1), lambda i: w[i] in ({firsts})) places from d),
s as (select doc_id, len(w)::bigint n_words, {", ".join(starts)} from r),
l as (select doc_id, n_words, {places} p, list_filter([{", ".join(names)}], lambda x: x is not null) found,
             list_filter([{", ".join(bases)}], lambda x: x is not null) base, greatest({", ".join(score)}) part from s)
select doc_id, n_words, len(p)::bigint n_base, (list_min(p) - 1)::bigint first_word, (list_max(p) - 1)::bigint last_word,
       array_to_string(list_sort(list_distinct(base)), ',') base_labels, array_to_string(list_sort(list_distinct(found)), ',') labels,
       case when len(found) > 0 then 1.0::double else part * 0.5::double end score from l"""


@query("op11_rare_token_licenses", _sql())
def rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    base = F.filter("licenses.places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id",
        "licenses.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("licenses.base_labels", ",").alias("base_labels"),
        F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score",
    )
