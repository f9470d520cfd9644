"""Fingerprints, Gray index, components and near copies against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from martloom.llm import simhash
from martloom.llm.components import components
from martloom.llm.simhash import batch_links, fingerprint, fingerprint_links, gray_rank, group_links, near_copies, one_of_each


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "é É ß\tx\x0by z", "a b c d " * 400, "w " * 7])
def test_fingerprint(text, monkeypatch):
    assert int(fingerprint(text, 3)[0]) == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 50)  # long texts are hashed in parts
    assert int(fingerprint(text, 3)[0]) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c') h").first().h % 2**64 == xxh64_intdigest("a b c", 42)


def test_gray_neighbours_differ_in_one_bit():
    codes = np.array([i ^ (i >> 1) for i in range(64)], dtype=np.uint64)
    assert gray_rank(codes).tolist() == list(range(64))


def labels(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def clustered(n, seed, flips=7):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, max(1, n // 10), dtype=np.uint64) * np.uint64(2)
    out = set()
    for _ in range(n):
        x = int(base[rng.integers(len(base))])
        for _ in range(int(rng.integers(0, flips))):
            x ^= 1 << int(rng.integers(64))
        out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


def brute_links(fps, radius):
    return [(i, j) for i in range(len(fps)) for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= radius)[0].tolist() if i < j]


@pytest.mark.parametrize("n,radius", [(1, 3), (2, 3), (60, 3), (900, 3), (900, 8)])
def test_group_links_span_all_links(n, radius):
    fps = clustered(n, n)
    links = group_links(fps, radius)
    assert len(links) < len(fps) or not links
    assert labels(len(fps), links) == labels(len(fps), brute_links(fps, radius))


@pytest.mark.parametrize("radius", [0, 3, 8])
def test_batch_links_span_the_links_of_every_group(radius):
    sizes = [1, 2, 3, 4, 5, 17, 100, 1, 128, 9]
    groups = [clustered(5 * n, n)[:n] for n in sizes]
    starts = np.cumsum([0, *map(len, groups)])
    links = batch_links(np.concatenate(groups), starts[:-1], radius)
    for fps, a, b in zip(groups, starts, starts[1:]):
        here = [(i - a, j - a) for i, j in links if a <= i < b]
        assert all(a <= j < b for i, j in links if a <= i < b) and len(here) < len(fps)
        assert labels(len(fps), here) == labels(len(fps), brute_links(fps, radius))


def test_small_groups_go_through_pruned_gray_nodes(monkeypatch):
    ranked, opened = [], []
    rank, children = simhash.gray_rank, simhash._children
    monkeypatch.setattr(simhash, "gray_rank", lambda v: ranked.append(len(v)) or rank(v))
    monkeypatch.setattr(simhash, "_children", lambda *a: opened.append(children(*a)) or opened[-1])
    rng = np.random.default_rng(1)
    # groups share 16 bits, as the first patterns make them; pairs of near ones inside
    groups = [np.unique(np.repeat(rng.integers(0, 2**47, 30, dtype=np.uint64), 2) ^ np.tile(np.array([0, 1], dtype=np.uint64), 30)) for _ in range(40)]
    starts = np.cumsum([0, *map(len, groups)])
    links = batch_links(np.concatenate(groups), starts[:-1], 3)
    assert len(links) == 40 * 30 and ranked == [starts[-1]]
    compared = len(opened[-1][1])  # pairs of fingerprints met at the last level
    assert compared < sum(len(g) ** 2 for g in groups) / 4


def test_no_group_stays_above_the_limit(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", 16)
    seen = []
    search = simhash._search
    monkeypatch.setattr(simhash, "_search", lambda *a: seen.append(1) or search(*a))
    fps = np.arange(64, dtype=np.uint64) << np.uint64(20)  # one hot region: 58 bits in common
    table = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps)], "id long, fp long")
    links = [(r.a, r.b) for r in fingerprint_links(table, 3, 4).collect()]
    assert len(seen) > 2 and set(labels(len(fps), links)) == {0}


@pytest.mark.parametrize("limit,radius,blocks", [(4096, 3, 4), (12, 3, 4), (40, 6, 7)])
def test_distributed_links(spark, monkeypatch, limit, radius, blocks):
    monkeypatch.setattr(simhash, "GROUP_ROWS", limit)
    fps = clustered(300, 5)
    fps = np.concatenate([fps, (fps[:40] & np.uint64(0xFFFF)) | np.uint64(1 << 40)])  # groups that need dividing
    fps = np.unique(fps)
    table = spark.createDataFrame([(i, int(f.astype(np.int64))) for i, f in enumerate(fps)], "id long, fp long")
    links = [(r.a, r.b) for r in fingerprint_links(table, radius, blocks).collect()]
    assert labels(len(fps), links) == labels(len(fps), brute_links(fps, radius))


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (201, 201)]
    found = {r.n: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "n").collect()}
    assert found == {**{i: 0 for i in range(51)}, **{k: 100 for k in range(100, 140)}, **{k: 200 for k in (200, 201, 202)}}
    assert components(spark.createDataFrame([], "a long, b long"), "n").count() == 0


def test_near_copies_of_edge_rows(spark):
    texts = [(5, "alpha beta gamma delta"), (3, "ALPHA beta  gamma\ndelta"), (9, None), (7, ""), (8, " "), (None, "alpha beta gamma delta"), (4, "other words here")]
    docs = spark.createDataFrame([(i, t, "c", 0) for i, t in texts] + [(4, "other words here", "c", 0)], "doc_id long, text string, fp string, root int")
    got = sorted((repr(r.doc_id), r.component_id) for r in near_copies(docs, "doc_id", "text").collect())
    assert got == sorted([("5", 3), ("3", 3), ("None", 3), ("9", 7), ("7", 7), ("8", 7), ("4", 4), ("4", 4)])
    assert near_copies(docs.limit(0), "doc_id", "text").count() == 0


def test_query_equals_brute_force(spark, data_dir):
    from martloom.llm.queries.op10_simhash import gray_simhash

    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = np.array([plain_fingerprint(r.text) for r in docs], dtype=np.uint64)
    roots = labels(len(docs), brute_links(fps, 3))
    want = {r.doc_id: (f"{int(f):016x}", docs[root].doc_id) for r, f, root in zip(docs, fps, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in gray_simhash(spark, data_dir).collect()} == want


def test_one_of_each_keeps_all_columns_and_one_row(spark):
    body = " ".join(f"word{i}" for i in range(200))
    rows = [(2, body, "x"), (1, body + " more", "y"), (1, body + " more", "y"), (3, "something else entirely " * 3, None), (4, None, "z"), (6, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = one_of_each(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert one_of_each(docs.filter(F.lit(False)), "doc_id", "text").count() == 0


def test_one_of_each_equals_brute_force(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    fps = np.array([plain_fingerprint(r.text) for r in rows], dtype=np.uint64)
    roots = labels(len(rows), brute_links(fps, 3))
    assert sorted(r.doc_id for r in one_of_each(docs, "doc_id", "text").collect()) == sorted({rows[root].doc_id for root in roots})
