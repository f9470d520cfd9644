"""License scans through a positional index of rare tokens.

A template is a licence's label and its mandatory key phrases, each with its word position in the
licence text. The index holds, for every word of a key phrase, postings (phrase, position in it).
Document frequencies of these words are counted over all documents; a phrase is looked up by its
words of highest IDF only. In each file the postings of a phrase's rare words are intersected by
relative position: a place survives if every rare word of the phrase points to the same start.
Surviving places are verified word by word, and a licence is found where all its key phrases stand
at their relative positions, give or take `slack` words.

A file that holds a phrase holds all its words, so looking up the rarest ones loses nothing. All of
it happens inside the file's own row: nothing is shuffled but one count for each template word.

Null texts count as empty: no words, no places, score 0. Repeated rows are judged alike, ties in
document frequency go to the earlier word of the phrase, and a long text is one array of its words.
An empty table gives an empty one. A column of the input named like the result is replaced; all
other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHIFT = 1 << 40  # place = phrase number * SHIFT + start


@dataclass(frozen=True)
class Template:
    label: str
    phrases: tuple[tuple[int, str], ...]  # (word position in the licence text, words)
    base: bool = False


# The three base phrases of the contract, then key phrases of well-known licence notices
# with their distances in the published texts.
TEMPLATES = (
    Template("mit", ((0, "under the mit license"),), True),
    Template("apache-2", ((0, "apache license version 2"),), True),
    Template("cc-by-nc", ((0, "cc by nc"),), True),
    Template("mit", ((0, "permission is hereby granted free of charge"), (25, "to deal in the software without restriction"))),
    Template("apache-2", ((0, "you may not use this file except in compliance with the license"),)),
    Template("bsd", ((0, "redistribution and use in source and binary forms"), (17, "the following conditions are met"))),
    Template("isc", ((0, "permission to use copy modify and or distribute this software"), (15, "with or without fee is hereby granted"))),
    Template("gpl-2", ((0, "gnu general public license version 2"),)),
    Template("gpl-3", ((0, "gnu general public license version 3"),)),
    Template("lgpl", ((0, "gnu lesser general public license"),)),
    Template("agpl-3", ((0, "gnu affero general public license"),)),
    Template("mpl-2", ((0, "subject to the terms of the mozilla public license"), (9, "v 2 0"))),
    Template("cc-by", ((0, "cc by 4 0"),)),
    Template("cc-by-sa", ((0, "cc by sa"),)),
    Template("cc-by-nd", ((0, "cc by nd"),)),
    Template("cc0", ((0, "cc0 1 0 universal"),)),
    Template("unlicense", ((0, "this is free and unencumbered software released into the public domain"),)),
)
RARE = 2  # words looked up for each phrase
SLACK = 3  # words by which a later key phrase may be displaced


@dataclass(frozen=True)
class Phrase:
    template: int
    at: int
    words: tuple[str, ...]


def phrases_of(templates: tuple[Template, ...]) -> list[Phrase]:
    return [Phrase(t, at, tuple(text.split())) for t, tpl in enumerate(templates) for at, text in tpl.phrases]


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_frequencies(docs: DataFrame, text: str, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """For each word of the templates: documents that hold it. As many entries as the templates have words."""
    vocabulary = sorted({w for p in phrases_of(templates) for w in p.words})
    held = docs.select(F.explode(F.array_intersect(words_of(F.col(f"`{text}`")), _strings(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def rare_words(phrase: Phrase, df: dict[str, int], rare: int = RARE) -> list[tuple[str, int]]:
    """The phrase's `rare` words of highest IDF, rarest first, with their first position in it."""
    first = {w: phrase.words.index(w) for w in phrase.words}
    ranked = sorted(first, key=lambda w: (df[w], first[w]))
    return [(w, first[w]) for w in ranked[:rare]]


def _postings(lookups: list[list[tuple[str, int]]], nth: int) -> tuple[list[str], Column]:
    """The words posted and a map word -> postings (place of a phrase that starts at word 0, minus the word's position) of every phrase's nth rare word."""
    by_word: dict[str, list[int]] = {}
    for number, words in enumerate(lookups):
        word, at = words[min(nth, len(words) - 1)]
        by_word.setdefault(word, []).append(number * SHIFT - at)
    return sorted(by_word), F.create_map(*[c for w, entries in by_word.items() for c in (F.lit(w), F.array(*[F.lit(e).cast("long") for e in entries]))])


def _places(words: Column, posted: list[str], postings: Column) -> Column:
    """All places to which the file's occurrences of the posted words point."""
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i")))
    hits = F.filter(numbered, lambda h: h["w"].isin(posted))
    return F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(postings, h["w"]), lambda p: p + h["i"])))


def _phrase(place: Column) -> Column:
    return F.shiftright(place, 40).cast("int")


def _start(place: Column) -> Column:
    return place.bitwiseAND(F.lit(SHIFT - 1))


def with_licenses(docs: DataFrame, text: str, templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE, slack: int = SLACK, out: str = "licenses") -> DataFrame:
    """`docs` with the struct `out`: n_words, places (phrase, label, base, start), labels, base_labels and score.

    The score is 1 where a licence is found; otherwise half the best share of a licence's key-phrase
    words that stand anywhere in the file.
    """
    df = document_frequencies(docs, text, templates)
    phrases = phrases_of(templates)
    lookups = [rare_words(p, df, rare) for p in phrases]
    anchors = _strings(sorted({w for words in lookups for w, _ in words[:1]}))
    texts = F.array(*[_strings(p.words) for p in phrases])
    none = F.array().cast("array<bigint>")

    words = docs.withColumn("__words", words_of(F.col(f"`{text}`")))
    # a place below word 0 borrows from the phrase number; its start is then far beyond the text and fails the check
    meet = reduce(F.array_intersect, [_places(F.col("__words"), *_postings(lookups, nth)) for nth in range(rare)])
    met = words.withColumn("__met", F.when(F.arrays_overlap("__words", anchors), meet).otherwise(none))

    def stands(place):
        wanted = F.element_at(texts, _phrase(place) + 1)
        return F.slice(F.col("__words"), (_start(place) + 1).cast("int"), F.size(wanted)) == wanted

    in_range = F.filter("__met", lambda p: (p >= 0) & (_start(p) < F.size("__words")))
    verified = met.withColumn("__in", in_range).withColumn("__at", F.array_sort(F.filter("__in", stands)))
    verified = verified.withColumn("__n", F.size("__words")).drop("__words", "__met", "__in")

    def starts(number):
        return F.transform(F.filter("__at", lambda p: _phrase(p) == number), _start)

    def origins(number, width):
        at = phrases[number].at
        return F.flatten(F.transform(starts(number), lambda s: F.sequence(s - at - width, s - at + width)))

    labelled, partial = [], []
    for t, template in enumerate(templates):
        own = [k for k, p in enumerate(phrases) if p.template == t]
        common = reduce(F.array_intersect, [origins(k, slack if i else 0) for i, k in enumerate(own)])
        total = sum(len(phrases[k].words) for k in own)
        seen = reduce(lambda a, b: a + b, [F.when(F.size(starts(k)) > 0, len(phrases[k].words)).otherwise(0) for k in own])
        labelled.append(F.when(F.size(common) > 0, F.struct(F.lit(template.label).alias("label"), F.lit(template.base).alias("base"))))
        partial.append(seen / F.lit(total))
    found = F.filter(F.array(*labelled), lambda t: t.isNotNull())
    names = F.array(*[F.lit(templates[p.template].label) for p in phrases])
    bases = F.array(*[F.lit(templates[p.template].base) for p in phrases])
    place = lambda p: F.struct(
        F.element_at(names, _phrase(p) + 1).alias("label"), F.element_at(bases, _phrase(p) + 1).alias("base"), _phrase(p).alias("phrase"), _start(p).alias("start")
    )
    some = F.size("__at") > 0
    nothing = F.array().cast("array<struct<label:string,base:boolean>>")
    judged = verified.withColumn("__found", F.when(some, found).otherwise(nothing))
    result = F.struct(
        F.col("__n").cast("long").alias("n_words"),
        F.transform("__at", place).alias("places"),
        F.array_sort(F.array_distinct(F.transform("__found", lambda t: t["label"]))).alias("labels"),
        F.array_sort(F.array_distinct(F.transform(F.filter("__found", lambda t: t["base"]), lambda t: t["label"]))).alias("base_labels"),
        F.when(F.size("__found") > 0, F.lit(1.0)).when(some, F.greatest(*partial, F.lit(0.0)) * 0.5).otherwise(F.lit(0.0)).alias("score"),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return judged.select(*kept, result.alias(out))
