"""Licence index against a plain scan of every position."""

from __future__ import annotations

import random
import re

import pytest

from martloom.llm.license_index import SLACK, TEMPLATES, Template, document_frequencies, phrases_of, rare_words, with_licenses


def plain(text, templates, slack):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts = {}
    for k, p in enumerate(phrases_of(templates)):
        n = len(p.words)
        starts[k] = [i for i in range(len(words) - n + 1) if tuple(words[i : i + n]) == p.words]
    labels, base, parts = set(), set(), [0.0]
    for t, template in enumerate(templates):
        own = [(k, p) for k, p in enumerate(phrases_of(templates)) if p.template == t]
        lead, first = own[0]
        if any(all(any(abs(j - i - p.at + first.at) <= slack for j in starts[k]) for k, p in own[1:]) for i in starts[lead]):
            labels.add(template.label)
            if template.base:
                base.add(template.label)
        parts.append(sum(len(p.words) for k, p in own if starts[k]) / sum(len(p.words) for _, p in own) * 0.5)
    places = sorted((k, i) for k, found in starts.items() for i in found)
    return len(words), places, sorted(labels), sorted(base), 1.0 if labels else max(parts)


def told(row):
    f = row["licenses"]
    return f["n_words"], sorted((p["phrase"], p["start"]) for p in f["places"]), f["labels"], f["base_labels"], f["score"]


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
TEXTS = [
    None,
    "",
    " \t\n",
    "Released under the MIT License.",
    "UNDER THE MIT LICENSE under the mit license, under the mit",
    "under the mit under the mit license license",
    "Apache License, Version 2.0; CC BY-NC 4.0, CC BY 4.0",
    "ünder the mit licenseé",
    "license\x00under\x7fthe~mit`license",
    MIT,
    MIT.replace("to any person", "to each and every person"),
    MIT.replace("to any person", "to any person or group of persons whoever they may be"),
    "permission is hereby granted free of charge",
    "version 2 of the apache license, version 2, version 2",
    "mit license the under " * 50,
    "a " * 30000 + "cc by nc " * 200,
]


def test_known_texts_against_plain_scan(spark):
    rows = [(i, t, "own", 7) for i, t in enumerate(TEXTS + TEXTS[3:5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string, __at int")
    found = with_licenses(docs.select("doc_id", "text", "licenses"), "text").collect()
    assert len(found) == len(rows)
    for r in found:
        assert told(r) == plain(r["text"], TEMPLATES, SLACK), r["text"]


@pytest.mark.parametrize("rare", [1, 2, 3])
def test_random_texts_and_templates(spark, rare):
    rng = random.Random(rare)
    words = ["a", "b", "c", "d"]
    templates = tuple(
        Template(f"t{i % 4}", tuple((9 * k, " ".join(rng.choices(words, k=rng.randint(1, 4)))) for k in range(rng.randint(1, 3))), i < 3) for i in range(7)
    )
    rows = [(i, " ".join(rng.choices(words + ["x"], k=rng.randint(0, 60)))) for i in range(60)]
    found = with_licenses(spark.createDataFrame(rows, "doc_id long, text string"), "text", templates, rare, 2).collect()
    for r in found:
        assert told(r) == plain(r["text"], templates, 2)


def test_rare_words_follow_document_frequency(spark):
    docs = spark.createDataFrame([("the the license",), ("the mit",), ("the",), (None,)], "text string")
    df = document_frequencies(docs, "text", TEMPLATES)
    assert (df["the"], df["mit"], df["license"], df["under"]) == (3, 1, 1, 0)
    assert rare_words(phrases_of(TEMPLATES)[0], df, 3) == [("under", 0), ("mit", 2), ("license", 3)]


def test_empty_table(spark):
    assert with_licenses(spark.createDataFrame([], "doc_id long, text string"), "text").count() == 0
