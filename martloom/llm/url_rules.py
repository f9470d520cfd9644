"""URL verdicts from host rules and from mined token rules.

Host rules: a rule `host/path` fits its host and all subdomains if the URL's path starts with the
rule's path; the longest one wins. A URL that no host rule fits is judged by association rules: FP-growth over
the tokens of labelled URLs finds token combinations that go with bad pages, kept if enough rows
support them, if the share of bad rows among those with the combination reaches the confidence (a fixed
one, or a multiple of the bad rows' overall share), and if no kept rule has part of the same tokens. Matching goes through an inverted index on each rule's rarest
token: only rules filed under a token the URL has are compared.

A null URL, or one without `://`, has an empty host and path and no tokens.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import materialise, sized

BAD = "label=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def fits(rule: HostRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def longest_rule(rules: tuple[HostRule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    text = reduce(lambda c, r: c.when(fits(r, host, path), r.text), ordered[1:], F.when(fits(ordered[0], host, path), ordered[0].text))
    verdict = reduce(lambda c, r: c.when(fits(r, host, path), r.verdict), ordered[1:], F.when(fits(ordered[0], host, path), ordered[0].verdict))
    return text, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path parts (numbers as one token), query keys, fragment."""
    rest = _rest(url)
    path = F.regexp_replace(path_of(url), "[0-9]+", "#")
    query = F.regexp_extract(rest, "^[^?#]*\\?([^#]*)", 1)
    parts = F.concat(
        F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1))),
        F.transform(F.split(host_of(url), "\\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))),
        F.array(F.concat(F.lit("f:"), F.regexp_extract(rest, "#(.*)$", 1))),
    )
    named = F.filter(F.array_distinct(parts), lambda x: F.length(x) > 2)
    return F.when(F.instr(url, "://") > 0, named).otherwise(F.array().cast("array<string>"))


def mined_rules(labelled: DataFrame, tokens: str, bad: str, min_rows: int, min_support: float, min_confidence: float, most_tokens: int | None = None, min_lift: float = 0.0) -> DataFrame:
    """(rule array<string>, support long, confidence double): minimal token combinations of bad rows.

    The confidence asked for is the larger of `min_confidence` and `min_lift` times the share of bad rows.

    `labelled` has an array of distinct tokens and a boolean; support counts rows with all the tokens
    and a bad label. FP-growth divides its work by item; the result is bounded by the support. Rules
    have any number of tokens, or up to `most_tokens` if given.
    """
    spark = labelled.sparkSession
    labelled = materialise(labelled.select(F.col(tokens).alias("_t"), F.col(bad).alias("_bad")).filter("_bad is not null and size(_t) > 0"), "labelled-urls")
    n, n_bad = labelled.agg(F.count(F.lit(1)), F.count_if("_bad")).first()
    min_confidence = max(min_confidence, min_lift * n_bad / n) if n else min_confidence
    least = max(min_rows, -(-int(n * min_support * 1_000_000) // 1_000_000))
    schema = "rule array<string>, support bigint, confidence double"
    if n < least:
        return spark.createDataFrame([], schema)
    items = labelled.select(F.when(F.col("_bad"), F.array_append("_t", BAD)).otherwise(F.col("_t")).alias("items"))
    # half a row below the count, so that no rounding lifts it
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(items)
    sets = materialise(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    with_bad = sets.filter(F.array_contains("items", BAD)).select(F.array_remove("items", BAD).alias("rule"), F.col("freq").alias("support"))
    plain = sets.filter(~F.array_contains("items", BAD)).select(F.col("items").alias("_i"), F.col("freq").alias("_n"))
    wanted = with_bad.filter(F.size("rule") > 0)
    if most_tokens is not None:
        wanted = wanted.filter(F.size("rule") <= most_tokens)
    judged_sets = wanted.join(plain, F.col("rule") == F.col("_i")).select("rule", "support", (F.col("support") / F.col("_n")).alias("confidence"))
    judged_sets = materialise(judged_sets, "judged-itemsets")
    confident = judged_sets.filter(F.col("confidence") >= min_confidence)
    low, high = confident.agg(F.min(F.size("rule")), F.max(F.size("rule"))).first()
    if low is None:
        return confident
    # a rule with more tokens than another kept one adds nothing. All parts of a frequent set are frequent, so what has
    # a confident part is found level by level, from the sets with one token less
    kept = above = confident.filter(F.size("rule") == low)
    above = above.select(F.col("rule").alias("_above"))
    for size in range(low + 1, high + 1):
        sets_here = judged_sets.filter(F.size("rule") == size)
        less = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda at: F.filter("rule", lambda x, i: i != at))
        parts = sets_here.select("rule", F.explode(less).alias("_part"))
        needless = materialise(parts.join(above, F.col("_part") == F.col("_above"), "left_semi").select("rule").distinct(), "needless-rules")
        fresh = confident.filter(F.size("rule") == size).join(needless, "rule", "left_anti")
        kept = kept.unionByName(fresh)
        above = needless.unionByName(fresh.select("rule")).select(F.col("rule").alias("_above"))
    return kept


def matched(urls: DataFrame, url: str, rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """(`url`) of the distinct URLs that some rule matches; `frequency` has token and n."""
    rules = materialise(rules, "url-rules")
    place = rules.withColumn("_id", F.xxhash64(F.concat_ws("\n", "rule")))
    filed = place.select("rule", "_id", F.explode("rule").alias("token")).join(frequency, "token", "left")
    rarest = filed.groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).alias("_m"))
    index = sized(rarest.select(F.col("_m.token").alias("_token"), F.col("rule")))
    spread = urls.select(url).distinct().withColumn("_t", tokens_of(F.col(url))).select(url, "_t", F.explode("_t").alias("_one"))
    hits = spread.join(index, F.col("_one") == F.col("_token")).filter(F.size(F.array_except("rule", "_t")) == 0)
    return hits.select(url).distinct()


def judged(
    pages: DataFrame,
    url: str,
    labelled: DataFrame,
    rules: tuple[HostRule, ...],
    min_rows: int = 20,
    min_support: float = 0.005,
    min_confidence: float = 0.5,
    min_lift: float = 0.0,
) -> DataFrame:
    """Add host, path, rule and verdict to every page; `labelled` has url and a boolean bad.

    Pages with equal URLs get equal verdicts. Columns of `pages` named like the four new ones are replaced.
    """
    pages = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")])
    known = materialise(labelled.select(tokens_of(F.col("url")).alias("_t"), "bad"), "url-tokens")
    frequency = known.select(F.explode("_t").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    mined = mined_rules(known, "_t", "bad", min_rows, min_support, min_confidence, min_lift=min_lift)
    hits = sized(matched(pages, url, mined, frequency).select(F.col(url).alias("_hit"), F.lit(True).alias("_bad")))
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    placed = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    joined = placed.join(hits, F.col(url) == F.col("_hit"), "left")
    mined_verdict = F.when(F.col("_bad"), "block").otherwise("allow")
    return joined.withColumn("rule", text).withColumn("verdict", F.coalesce(verdict, mined_verdict)).drop("_hit", "_bad")
