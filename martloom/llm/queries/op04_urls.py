"""Verdict of every page's URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.registry import query
from martloom.llm.tables import table
from martloom.llm.url_rules import HostRule, judged, path_of

# The host rules of the contract
RULES = (
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
)
# a rule needs 20 bad rows and 1.75 times the bad rows' overall share
MIN_ROWS, MIN_SUPPORT, MIN_LIFT = 20, 0.005, 1.75

SQL = f"""
with u as (select page_id, url, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end rest from pages),
p as (select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path, rest from u),
t as (select page_id, host, path, case when contains(url, '://') then list_sort(list_filter(list_distinct(
        ['s:' || split_part(url, '://', 1)]
        || list_transform(string_split(host, '.'), lambda x: 'h:' || x)
        || list_transform(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: 'p:' || x)
        || list_transform(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: 'q:' || split_part(x, '=', 1))
        || ['f:' || regexp_extract(rest, '#(.*)$', 1)]), lambda x: length(x) > 2)) else []::varchar[] end tok from p),
l as (select row_number() over () rid, tok, (toxic = 1 or quality = 0) bad from t join labels on doc_id = try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) as bigint)
      where quality is not null and toxic is not null and len(tok) > 0),
m as (select greatest({MIN_ROWS}, ceil(count(*) * {MIN_SUPPORT})) least, {MIN_LIFT} * count(*) filter (where bad) / count(*) least_share from l),
e as (select rid, bad, unnest(tok) x from l),
c as (select [x] r, bad from e
      union all select [a.x, b.x], a.bad from e a join e b on a.rid = b.rid and a.x < b.x
      union all select [a.x, b.x, c.x], a.bad from e a join e b on a.rid = b.rid and a.x < b.x join e c on b.rid = c.rid and b.x < c.x),
g as (select r, count(*) filter (where bad) support, count(*) n from c group by r),
k as (select r from g, m where support >= least and support / n >= least_share),
h as (select distinct page_id from t join k on list_has_all(tok, r)),
v as (select t.page_id, host, path,
        case when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
             when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
             when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
             when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
             when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end rule,
        h.page_id is not null hit
      from t left join h on h.page_id = t.page_id)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' when hit then 'block' else 'allow' end verdict
from v"""


@query("op4_mined_url_rules", SQL)
def mined_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number in a URL's path names the page's document: toxic or low-quality ones are bad."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    number = F.regexp_extract(path_of(F.col("url")), "([0-9]+)[^0-9]*$", 1).try_cast("long")
    labelled = pages.join(labels.filter("bad is not null"), number == F.col("doc_id"))
    found = judged(pages, "url", labelled, RULES, MIN_ROWS, MIN_SUPPORT, 0.0, MIN_LIFT)
    return found.select("page_id", "host", "path", "rule", "verdict")
