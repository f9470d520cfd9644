"""Secret scans over a ledger of text blobs.

Every version of every file is addressed by the SHA-256 of its text. The ledger has one row for each
(blob, rule, rule version) ever scanned, with the spans found. A run scans only pairs the ledger
doesn't have yet: a blob seen under another path costs nothing, a changed rule rescans that rule only.
Findings are joined back to all paths that hold the blob.

Null texts count as empty. Offsets are code points, ends are exclusive. Matches of one rule are
leftmost and don't overlap; matches whose secret part is too short are dropped after matching.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialise, sized


@dataclass(frozen=True)
class Rule:
    name: str
    version: int
    pattern: str
    group: int  # the part whose length counts
    least: int

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The three base rules in the order of the contract. A run of fixed characters below
# the minimum can't hold a longer match, so the minimum is part of the last two patterns.
BASE_RULES = (
    Rule(
        "assign",
        1,
        "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1,
        12,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
)

LEDGER = "blob binary, rule string, version int, spans array<struct<start:bigint,end:bigint>>"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _lengths(text: Column, rule: Rule) -> Column:
    """For each match: code points before it since the last one, its own, and those of the judged part."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), part.alias("part")),
        lambda m: F.struct(
            F.length(m["gap"]).cast("long").alias("gap"), F.length(m["whole"]).cast("long").alias("size"), F.length(m["part"]).alias("judged")
        ),
    )


def scan_unseen(texts: DataFrame, text: str, rules: tuple[Rule, ...], ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows: every (blob, rule, version) of `texts` that `ledger` lacks.

    Copies of a text are folded before the shuffle, and one scan per pair is written at once, so the
    regular expressions run one time for each pair.
    """
    blobs = (
        texts.select(F.coalesce(text, F.lit("")).alias("_text"))
        .groupBy(blob_of(F.col("_text")).alias("blob"))
        .agg(F.first("_text").alias("_text"))
    )
    if ledger is None:
        known = F.array().cast("array<string>")
        blobs = blobs.withColumn("_known", known)
    else:
        # at most one entry for each rule and version
        seen = ledger.groupBy(F.col("blob").alias("_b")).agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("_known"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        seen = seen.select("_b", F.array_intersect("_known", wanted).alias("_known"))
        blobs = blobs.join(seen, F.col("blob") == F.col("_b"), "left").drop("_b")
        blobs = blobs.withColumn("_known", F.coalesce("_known", F.array().cast("array<string>")))
        blobs = blobs.filter(F.size("_known") < len(rules))
    none = "array<struct<gap:bigint,size:bigint,judged:int>>"
    scans = []
    for r in rules:
        hit = F.when(F.col("_text").rlike(r.pattern), _lengths(F.col("_text"), r)).otherwise(F.array().cast(none))
        scan = F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"), hit.alias("found"))
        scans.append(F.when(~F.array_contains("_known", r.key), scan))
    raw = materialise(
        blobs.select("blob", F.explode(F.array(*scans)).alias("_s")).filter("_s is not null").select("blob", "_s.*"), "scans"
    )
    key = ["blob", "rule", "version"]
    run = Window.partitionBy(*key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)  # matches of one text
    spans = (
        raw.filter(F.size("found") > 0)
        .select(*key, "least", F.posexplode("found").alias("_i", "_m"))
        .withColumn("end", F.sum(F.col("_m.gap") + F.col("_m.size")).over(run))
        .filter(F.col("_m.judged") >= F.col("least"))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("_m.size")).alias("start"), "end"))).alias("spans"))
    )
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    scanned = raw.select(*key)
    return scanned.join(sized(spans), key, "left").withColumn("spans", F.coalesce("spans", nothing))


def with_findings(paths: DataFrame, text: str, rules: tuple[Rule, ...], ledger: DataFrame) -> DataFrame:
    """Every row of `paths` with `secrets`: its spans under the current rules, sorted by start, then rule order.

    Null texts have none; repeated rows get the same spans. A column of `paths` called `secrets` is replaced.

    Only blobs with a finding take part in the join, and they are written first, so a blob that very
    many paths share is split by Spark like any hot key.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    one = F.struct(F.col("_s.start"), F.col("_rank").alias("rank"), F.col("_s.end"), F.col("rule"))
    found = (
        ledger.withColumn("_rank", order[F.concat_ws("@", "rule", "version")])
        .filter(F.col("_rank").isNotNull() & (F.size("spans") > 0))
        .select("blob", "rule", "_rank", F.explode("spans").alias("_s"))
        .groupBy(F.col("blob").alias("_b"))
        .agg(F.array_sort(F.collect_list(one)).alias("secrets"))
    )
    # findings grow with the data: a merge join at every size, not a broadcast at small ones
    paths = paths.select([F.col(f"`{c}`") for c in paths.columns if c != "secrets"])
    joined = paths.withColumn("_blob", blob_of(F.col(text))).join(sized(found).hint("merge"), F.col("_blob") == F.col("_b"), "left")
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,rule:string>>")
    return joined.withColumn("secrets", F.coalesce("secrets", empty)).drop("_blob", "_b")


def spans_text(secrets: Column, only: tuple[str, ...] | None = None) -> Column:
    if only:
        secrets = F.filter(secrets, lambda s: s["rule"].isin(*only))
    return F.concat_ws(",", F.transform(secrets, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, secrets: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by `mark`; overlapping spans are merged into one."""
    spans = F.transform(secrets, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: F.substring(text, (p["s"] + 1).cast("int"), (p["e"] - p["s"]).cast("int")))
    return F.when(F.size(secrets) == 0, text).otherwise(F.array_join(kept, mark))
