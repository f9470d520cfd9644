"""Pieces, toxicity, benchmark leaks, URL rules and nearest vectors."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from martloom.llm import nearest
from martloom.llm.decontaminate import Index, as_item, judged, leaks, shingles, words_of
from martloom.llm.nearest import top_products
from martloom.llm.pieces import Encoder, Pieces, decoded, encoded
from martloom.llm.toxicity import fit_chain, scored
from martloom.llm.url_rules import mined_rules

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ODD = ["", " ", "  a  b ", "a\n\n b", "x" * 300, "日本語テキスト😀", "<s> </s> <0x0A>", "\t tab", "a   ", "▁a ▁▁ b▁", "ﬁ\u0000\ud7ff", "the quick brown fox " * 50]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def test_without_dropout_ids_are_the_librarys(pieces, spark, data_dir):
    texts = [r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()] + [t for t in ODD if "▁" not in t]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert Encoder(pieces).encode(texts, [0] * len(texts)) == model.encode(texts)


@pytest.mark.parametrize("dropout,streams", [(0.0, 1), (0.1, 1), (0.3, 4), (1.0, 2)])
def test_decoding_is_lossless(pieces, dropout, streams):
    ids = Encoder(pieces, dropout, 5, streams).encode([*ODD, None], list(range(len(ODD) + 1)))
    assert ids[-1] is None
    assert [pieces.decode(i) for i in ids[:-1]] == ODD


def test_dropout_depends_on_its_key_alone(pieces):
    text = ["internationalization of segmentation algorithms " * 20]
    one, again, other = (Encoder(pieces, 0.2, s, 4).encode(text, [1])[0] for s in (1, 1, 2))
    assert one == again and one != other
    assert one != Encoder(pieces, 0.2, 1, 4).encode(text, [2])[0]
    assert len(one) > len(Encoder(pieces).encode(text, [1])[0])
    assert len(set(map(tuple, np.array_split(np.array(one), 20)))) > 1
    # no dropped merges are left to chance by how texts are batched
    mixed = Encoder(pieces, 0.2, 1, 4).encode(["other words", *text, "more"], [9, 1, 8])
    assert mixed[1] == one


def test_array_and_heap_agendas_agree(pieces):
    enc = Encoder(pieces, 0.25, 3, 2)
    random.seed(2)
    units = ["▁" + "".join(random.choice("etaoinshrdlu") for _ in range(random.randint(1, 40))) for _ in range(300)]
    todo = [(u, s) for u in units for s in (0, 1)]
    assert all(ids == enc._heap(unit, stream) for unit, stream, ids in enc.segment(todo))


def test_every_occurrence_draws_anew(pieces, monkeypatch):
    from martloom.llm import pieces as module

    unit, n = "▁internationalization", 400
    enc = Encoder(pieces, 0.1, 3)
    _, (ids,) = enc.encode(["filler", "x" + unit.replace("▁", " ") * n], [4, 9]), enc.encode(["x" + unit.replace("▁", " ") * n], [9])
    # brute force: the heap with the key of each document and place
    draws = module._mix(np.uint64((9 * 0x9E3779B97F4A7C15 + 3) & module.WORD) + np.arange(n + 1, dtype=np.uint64)).tolist()
    want = [enc._heap("▁x", draws[0]), *[enc._heap(unit, d) for d in draws[1:]]]
    assert ids == [i for w in want for i in w]
    assert len(set(want[1:])) > 20  # two with two streams
    # units too long to remember, and a forgetful task, give the same
    for name, value in (("LONGEST_KEPT", 2), ("KEPT", 0)):
        monkeypatch.setattr(module, name, value)
        assert Encoder(pieces, 0.1, 3).encode(["x" + unit.replace("▁", " ") * n], [9]) == [ids]


def test_long_texts_are_chunked_at_unit_borders(pieces, monkeypatch):
    from martloom.llm import pieces as module

    text = "some words  and\nlines " * 40
    whole = Encoder(pieces, 0.2, 1, 4).encode([text], [1])
    monkeypatch.setattr(module, "CHUNK", 37)
    assert Encoder(pieces, 0.2, 1, 4).encode([text], [1]) == whole


def test_encode_and_decode_tables(spark):
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate([*ODD, None])] + [(None, "null id", "old")], "doc_id long, text string, ids string")
    table = encoded(docs, "doc_id", "text", MODEL)
    assert table.columns == ["doc_id", "text", "ids", "lossless"]
    back = decoded(table.withColumnRenamed("text", "before"), "ids", MODEL).collect()
    assert all(r.before == r.text and r.lossless in (True, None) for r in back) and len(back) == len(ODD) + 2
    assert encoded(docs.limit(0), "doc_id", "text", MODEL).count() == 0


def test_toxicity_on_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rules = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
    chain = fit_chain(docs, "text", labels.filter("doc_id % 4 > 0"), "doc_id", rules, sample=5000)
    assert chain.links[1] and chain.links[1][0] != 0
    found = scored(docs.join(labels.filter("doc_id % 4 = 0"), "doc_id"), "text", chain).select("toxic", (F.col("p_toxic") >= 0.2).alias("p")).collect()
    right = sum(r.p for r in found if r.toxic)
    assert right >= 0.9 * sum(r.toxic for r in found)
    assert sum(r.p for r in found if not r.toxic) <= 0.01 * len(found)


def test_toxicity_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.0), (2, "", 0.0), (None, "bad words", 1.0)], "doc_id long, text string, p_toxic double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rules = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
    found = scored(docs, "text", fit_chain(docs, "text", none, "doc_id", rules)).collect()
    assert len(found) == 3 and all(r.p_toxic < 1e-9 for r in found)
    same = spark.createDataFrame([(1, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert all(r.p_toxic > 0.99 for r in scored(docs, "text", fit_chain(docs, "text", same, "doc_id", rules)).collect())


@pytest.fixture(scope="module")
def items(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/benchmark.parquet").orderBy("item_id").collect()
    return [as_item(r.item_id, r.text) for r in rows]


def test_wand_retrieves_all_above_threshold(items):
    index = Index(items, 0.6)
    random.seed(1)
    vocabulary = list(index.vocab.values())
    for n in range(200):
        own = index.term_ids(list(items[n % len(items)].words[: random.randint(5, 60)]))
        terms = sorted({*random.sample(vocabulary, 40), *own.tolist()})
        scores = np.zeros(len(items))
        for t in terms:
            scores[index.docs[t]] += index.parts[t]
        assert sorted(d for d, _ in index.retrieve(terms)) == np.nonzero(scores >= 0.6 - 1e-9)[0].tolist()


def test_leaks_equal_brute_force(items, spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    index = Index(items, 0.6)
    retrieved, leaked = judged(index, [r.text for r in docs], 0.8)
    for r, some, found in zip(docs, retrieved, leaked):
        grams = set(shingles(words_of((r.text or "").lower())))
        want = {d for d, g in enumerate(index.item_shingles) if sum(x in grams for x in g) >= 0.9 * len(g)}
        assert want <= found <= some
    assert any(leaked)


def test_planted_and_edited_passages(spark, monkeypatch):
    from martloom.llm import decontaminate

    item = "Which river flows through the old northern capital city today? It is the wide Varnel river of course."
    edited = item.replace("northern", "southern").lower()
    filler = " ".join(f"filler{i % 97} text" for i in range(3000))
    rows = [(1, item), (2, f"{filler} {edited} {filler}"), (3, filler), (4, None), (5, ""), (6, "It is the wide Varnel river of course."), (None, item)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, leaked string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, item), (10, item)], "item_id long, text string")
    for chars in (1 << 20, 500):  # texts are read in parts
        monkeypatch.setattr(decontaminate, "CHARS", chars)
        found = {r.doc_id: r.leaked for r in leaks(docs, "text", bench).collect()}
        assert found == {1: [7, 10], 2: [7, 10], 3: [], 4: [], 5: [], 6: [], None: [7, 10]}
    monkeypatch.setattr(decontaminate, "SLICE", 1)  # a benchmark larger than one index
    assert {r.doc_id: r.leaked for r in leaks(docs, "text", bench).collect()} == found
    assert all(r.leaked == [] for r in leaks(docs, "text", bench.limit(0)).collect())


def test_results_do_not_depend_on_slices(spark, monkeypatch):
    from martloom.llm import decontaminate

    random.seed(7)
    word = lambda: f"w{int(random.random() ** 3 * 300)}"
    # items of very unlike lengths and words of very unlike frequency
    texts = [" ".join(word() for _ in range(random.choice([6, 12, 50]))) + ". " + " ".join(word() for _ in range(4)) for _ in range(60)]
    bench = spark.createDataFrame([*enumerate(texts), (60, texts[0]), (61, "..."), (None, "x y")], "item_id long, text string")
    passages = []
    for n in range(120):
        cut = texts[n % 60].split()
        noise = [word() for _ in range(n % 40)]
        passages.append(" ".join(noise + cut[: max(3, len(cut) * (n % 11) // 10)] + noise))
    docs = spark.createDataFrame(list(enumerate([*passages, None, ""])), "doc_id long, text string")

    def found():
        return sorted((r.doc_id, tuple(r.retrieved), tuple(r.leaked)) for r in leaks(docs, "text", bench).collect())

    whole = found()
    index = Index([as_item(i, t) for i, t in [*enumerate(texts), (60, texts[0])]], 0.6)
    retrieved, leaked = judged(index, [*passages, None, ""], 0.8)
    name = lambda ids: tuple(sorted(index.items[d].item_id for d in ids))
    assert whole == [(n, name(a), name(b)) for n, (a, b) in enumerate(zip(retrieved, leaked))]
    assert 20 < sum(bool(r) for _, r, _ in whole) < 122
    for limit in (25, 7):
        monkeypatch.setattr(decontaminate, "SLICE", limit)
        assert found() == whole


def test_mined_rules_are_minimal_and_confident(spark):
    rows = [(["a", "b"], True)] * 30 + [(["a"], False)] * 40 + [(["b", "c"], True)] * 25 + [(["c"], False)] * 50 + [([], True), (None, True), (["a"], None)]
    found = mined_rules(spark.createDataFrame(rows, "t array<string>, bad boolean"), "t", "bad", 10, 0.01, 0.6, 3).collect()
    assert [(r.rule, r.support, r.confidence) for r in found] == [(["b"], 55, 1.0)]
    few = mined_rules(spark.createDataFrame(rows[:5], "t array<string>, bad boolean"), "t", "bad", 10, 0.01, 0.6, 3)
    assert few.count() == 0


def test_url_rules_on_odd_urls(spark):
    from martloom.llm.queries.op04_urls import RULES
    from martloom.llm.url_rules import judged as judged_urls

    urls = ["http://A.Example.ORG/es/1", "https://x.com/fr/a?b", "x.com/fr/", None, "", "ftp://com/de/", "http://org", "http://a.org?x=/", "http://notorg/", "s://u://v/w"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, verdict string")
    bad = spark.createDataFrame([("http://bad.net/x/1", True)] * 30 + [("http://good.net/y", False)] * 60, "url string, bad boolean")
    more = pages.unionByName(spark.createDataFrame([(50, "http://bad.net/zz", ""), (51, "http://sub.good.net/y", "")], pages.schema))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged_urls(more, "url", bad, RULES).collect()}
    assert found[0] == found[10] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[1] == ("x.com", "/fr/a", "com/fr/", "allow")
    assert found[2][:3] == found[3][:3] == found[4][:3] == ("", "", None)
    assert found[5] == ("com", "/de/", "com/de/", "block")
    assert found[6][:3] == ("org", "", None) and found[7][:3] == ("a.org", "", None) and found[8][2] is None
    assert found[9][:2] == ("u:", "//v/w")
    assert found[50][3] == "block" and found[51][3] == "allow"
    assert judged_urls(pages.limit(0), "url", bad.limit(0), RULES).count() == 0


def brute_top(rows, k):
    vectors = {}
    usable = [(i, np.floor(np.array(v) * 1024).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, v in usable:
        if i % 100 == 0:
            vectors.setdefault(i, v)
    out = []
    for q, v in vectors.items():
        near = sorted((-int(v @ w), i) for i, w in usable if i != q)[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("page", [2048, 40])
def test_top_products_equal_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(nearest, "PAGE", page)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.choice([0.1, 1, 5])]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # one vector very often
    rows += [(2000, None), (2100, [1.0, None] * 4), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8), (None, rows[0][1]), (2400, [0.0] * 8)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    found = top_products(table, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10).collect()
    assert sorted(tuple(r) for r in found) == brute_top(rows, 10)


def test_few_vectors_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    found = top_products(table, "vec_id", "embedding", F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in found] == [(1, 1), (2, 2)]
    assert top_products(table.limit(0), "vec_id", "embedding", F.col("vec_id") % 100 == 0).count() == 0


def test_rules_of_many_tokens_against_brute_force(spark):
    random.seed(4)
    rows = [([t for t in "abcdef" if random.random() < 0.7],) for _ in range(600)]
    rows = [(t, set("abcd") <= set(t) or set("ef") <= set(t) and random.random() < 0.45 or random.random() < 0.1) for (t,) in rows]
    found = mined_rules(spark.createDataFrame(rows, "t array<string>, bad boolean"), "t", "bad", 10, 0.01, 0.8).collect()
    want: dict[tuple, tuple] = {}
    for size in range(1, 7):
        for rule in combinations("abcdef", size):
            labels = [bad for t, bad in rows if set(rule) <= set(t)]
            if sum(labels) >= 10 and sum(labels) / len(labels) >= 0.8 and not any(set(r) < set(rule) for r in want):
                want[rule] = sum(labels), sum(labels) / len(labels)
    assert max(map(len, want)) >= 4
    assert {tuple(r.rule): (r.support, r.confidence) for r in found} == want


def test_a_part_two_tokens_smaller_makes_a_rule_needless(spark):
    # a is confident, its pairs and b+c are not, a+b+c is again
    rows = [(["a"], True)] * 90 + [(["a", "b"], False)] * 11 + [(["a", "c"], False)] * 11 + [(["a", "b", "c"], True)] * 10
    rows += [(["b", "c"], False)] * 10
    found = mined_rules(spark.createDataFrame(rows, "t array<string>, bad boolean"), "t", "bad", 5, 0.01, 0.8).collect()
    assert [r.rule for r in found] == [["a"]]


def test_rules_by_lift_block_pages(spark):
    from martloom.llm.queries.op04_urls import RULES
    from martloom.llm.url_rules import judged as judged_urls

    # three in ten pages are bad; six in ten of those with `bets` are, and none alone reaches a half but for them
    bad = [(f"http://x.net/bets/{i}", i % 10 < 6) for i in range(100)] + [(f"http://x.net/news/{i}", i % 10 < 2) for i in range(300)]
    labelled = spark.createDataFrame(bad, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://y.net/bets/7"), (2, "http://y.net/news/7"), (3, "http://a.org/bets/1")], "page_id long, url string")
    found = {r.page_id: r.verdict for r in judged_urls(pages, "url", labelled, RULES, 20, 0.005, 0.0, 1.75).collect()}
    assert found == {1: "block", 2: "allow", 3: "allow"}
    none = {r.page_id: r.verdict for r in judged_urls(pages, "url", labelled, RULES, 20, 0.005, 0.0, 2.5).collect()}
    assert set(none.values()) == {"allow"}
