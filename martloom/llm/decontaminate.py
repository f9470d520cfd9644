"""Benchmark decontamination: every training passage as a query against a BM25 index of test items.

The test items are indexed in slices of bounded size, so what travels to executors has a fixed bound
however large the benchmark is. Document frequencies, mean length and longest item are those of the
whole benchmark, so that results don't depend on the slices. Scores are divided by the score an item
gives itself; a passage retrieves an item when it reaches `threshold` of that.

Passages are windows of 2L + EDGE words every L words over the whole text, L being the longest item
of the benchmark, so that every run as long as an item lies inside one window. For each batch of texts,
the postings of the rarer terms are summed for each (window, item); with all that the frequent terms
could add, this bounds the score from above, and windows whose bound stays below the threshold for
every item are done. The others run block-max WAND over the whole index, which retrieves every
item above the threshold. A retrieved item is verified: the share of its question's and of its
answer's words that lie in five-word shingles shared with the window must both reach `overlap`. The
answer is the item's last sentence (the second half if it has one sentence only).

Words are lower-cased runs of letters and digits. Null texts count as empty. Items without words or
without an id are left out; equal items are each reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import repeat
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import materialise

SLICE = 10_000  # test items in one index
BLOCK = 32  # postings in a block
EDGE = 16
SHINGLE = 5
K1, B = 1.2, 0.75
BATCH_WORDS = 1 << 18
CHARS = 1 << 20  # of a text read at once

words_of = re.compile(r"\w+").findall


@dataclass(frozen=True)
class Item:
    item_id: int
    words: tuple[str, ...]
    answer_from: int  # index of the answer's first word


def as_item(item_id: int, text: str) -> Item | None:
    words = tuple(words_of((text or "").lower()))
    if not words or item_id is None:
        return None
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if words_of(s)]
    answer = len(words_of(sentences[-1].lower())) if len(sentences) > 1 else len(words) // 2
    return Item(item_id, words, len(words) - answer)


def shingles(words) -> list[tuple[str, ...]]:
    n = min(SHINGLE, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


@dataclass(frozen=True)
class Statistics:
    """Of a whole benchmark; `df` only needs the words of the items it is used for."""

    items: int
    words: int
    longest: int
    df: dict[str, int]


def statistics_of(items: list[Item]) -> Statistics:
    df: dict[str, int] = {}
    for item in items:
        for w in set(item.words):
            df[w] = df.get(w, 0) + 1
    sizes = [len(i.words) for i in items]
    return Statistics(len(items), sum(sizes), max(sizes), df)


class Index:
    """Postings with normalised BM25 parts, in blocks with their maxima."""

    def __init__(self, items: list[Item], threshold: float, whole: Statistics | None = None):
        self.items, self.threshold = items, threshold
        whole = whole or statistics_of(items)
        self.vocab: dict[str, int] = {}
        counts: list[dict[int, int]] = []
        for item in items:
            tf: dict[int, int] = {}
            for w in item.words:
                t = self.vocab.setdefault(w, len(self.vocab))
                tf[t] = tf.get(t, 0) + 1
            counts.append(tf)
        n, terms = len(items), len(self.vocab)
        df = np.array([whole.df[w] for w in self.vocab], dtype=float)
        idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
        mean = whole.words / whole.items
        lists: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for d, (item, tf) in enumerate(zip(items, counts)):
            flat = K1 * (1 - B + B * len(item.words) / mean)
            part = {t: idf[t] * f * (K1 + 1) / (f + flat) for t, f in tf.items()}
            own = sum(part.values())
            for t, v in part.items():
                lists[t].append((d, v / own))
        self.docs = [np.array([d for d, _ in x], dtype=np.int64) for x in lists]
        self.parts = [np.array([v for _, v in x]) for x in lists]
        self.top = np.array([p.max() for p in self.parts])
        self.block_last = [d[BLOCK - 1 :: BLOCK] if len(d) % BLOCK == 0 else np.append(d[BLOCK - 1 :: BLOCK], d[-1]) for d in self.docs]
        self.block_top = [np.maximum.reduceat(p, np.arange(0, len(p), BLOCK)) for p in self.parts]
        self.span = whole.longest
        # frequent terms: the longest lists, as long as no item gets over half the threshold from them
        self.frequent = np.zeros(n)
        rare = np.ones(terms, dtype=bool)
        for t in np.argsort([-len(d) for d in self.docs], kind="stable").tolist():
            more = self.frequent.copy()
            more[self.docs[t]] += self.parts[t]
            if more.max() > threshold / 2:
                break
            self.frequent, rare[t] = more, False
        sizes = np.array([len(d) if r else 0 for d, r in zip(self.docs, rare)], dtype=np.int64)
        self.begin = np.concatenate(([0], np.cumsum(sizes)))
        self.rare_docs = np.concatenate([d for d, r in zip(self.docs, rare) if r] or [np.zeros(0, dtype=np.int64)])
        self.rare_parts = np.concatenate([p for p, r in zip(self.parts, rare) if r] or [np.zeros(0)])
        self.item_shingles = [shingles(i.words) for i in items]
        # the walk over single postings is quicker on plain lists
        self.walk = [
            (d.tolist(), p.tolist(), bl.tolist(), bt.tolist(), float(t))
            for d, p, bl, bt, t in zip(self.docs, self.parts, self.block_last, self.block_top, self.top)
        ]

    def term_ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def promising(self, terms: np.ndarray, window: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Windows whose bound reaches the threshold for some item.

        `window` is the last window of each position; it also lies in the `more` windows before it.
        """
        at = np.nonzero(terms >= 0)[0]
        sizes = self.begin[terms[at] + 1] - self.begin[terms[at]]
        at, sizes = at[sizes > 0], sizes[sizes > 0]
        if not len(at):
            return np.zeros(0, dtype=np.int64)
        # each term once in a window
        vocab = len(self.vocab)
        seen = [(window[at[more[at] >= back]] - back) * vocab + terms[at[more[at] >= back]] for back in range(int(more.max()) + 1)]
        seen = np.unique(np.concatenate(seen))
        term = seen % vocab
        sizes = self.begin[term + 1] - self.begin[term]
        posting = np.repeat(self.begin[term], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        key = np.repeat(seen // vocab, sizes) * len(self.items) + self.rare_docs[posting]
        unique, where = np.unique(key, return_inverse=True)
        bound = np.bincount(where, weights=self.rare_parts[posting]) + self.frequent[unique % len(self.items)]
        return np.unique(unique[bound >= self.threshold - 1e-9] // len(self.items))

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose normalised score for the distinct `terms` reaches the threshold."""
        found: list[tuple[int, float]] = []
        # per term: next item, cursor, postings
        lists = [[self.walk[t][0][0], 0, *self.walk[t]] for t in terms]
        least = self.threshold - 1e-9
        by_doc = itemgetter(0)
        while True:
            lists.sort(key=by_doc)
            total, pivot = 0.0, -1
            for k, entry in enumerate(lists):
                total += entry[6]
                if total >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            doc = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == doc:
                pivot += 1
            # what the blocks around `doc` can give, and where the nearest of them ends
            total, end = 0.0, None
            for entry in lists[: pivot + 1]:
                b = bisect_left(entry[4], doc)
                if b < len(entry[4]):
                    total += entry[5][b]
                    end = entry[4][b] if end is None else min(end, entry[4][b])
            target = doc
            if total >= least:
                if lists[0][0] == doc:
                    score = sum(entry[3][entry[1]] for entry in lists[: pivot + 1])
                    if score >= least:
                        found.append((doc, score))
                    target = doc + 1
            else:
                # no item before the end of these blocks, or before the next list joins in
                target = doc + 1 if end is None else end + 1
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0])
            over = False
            for entry in lists[: pivot + 1]:
                if entry[0] < target:
                    entry[1] = bisect_left(entry[2], target, entry[1])
                    if entry[1] < len(entry[2]):
                        entry[0] = entry[2][entry[1]]
                    else:
                        entry[0], over = None, True
            if over:
                lists = [entry for entry in lists if entry[0] is not None]

    def verified(self, d: int, window: list[str], overlap: float) -> bool:
        item, grams = self.items[d], self.item_shingles[d]
        width = len(grams[0])
        there = set(zip(*[window[i:] for i in range(width)]))
        covered = np.zeros(len(item.words), dtype=bool)
        for i, g in enumerate(grams):
            if g in there:
                covered[i : i + width] = True
        question, answer = covered[: item.answer_from], covered[item.answer_from :]
        return all(part.mean() >= overlap for part in (question, answer) if len(part))


class _Batch:
    """Windows of several texts, judged together."""

    def __init__(self, index: Index, overlap: float):
        self.index, self.overlap, self.stride = index, overlap, index.span
        self.width = 2 * index.span + EDGE
        self.clear()

    def clear(self):
        self.pieces, self.windows, self.size = [], 0, 0

    def add(self, owner: int, words: list[str]) -> None:
        """Words of a text from a window's begin on; windows start every `stride` words."""
        self.pieces.append((owner, self.windows, words))
        self.windows += max(1, -(-len(words) // self.stride))
        self.size += len(words)

    def judge(self, retrieved: list[set], leaked: list[set]) -> None:
        if not self.pieces:
            return
        index, stride = self.index, self.stride
        terms, window, more = [], [], []
        for _, base, words in self.pieces:
            place = np.arange(len(words))
            last = place // stride
            terms.append(index.term_ids(words))
            window.append(base + last)
            # windows before the last one that still reach this place
            reach = (self.width - 1 - place % stride) // stride
            more.append(np.minimum(last, reach))
        hot = index.promising(np.concatenate(terms), np.concatenate(window), np.concatenate(more))
        bases = np.array([base for _, base, _ in self.pieces])
        for w in hot.tolist():
            k = int(np.searchsorted(bases, w, side="right")) - 1
            owner, base, words = self.pieces[k]
            passage = words[(w - base) * stride : (w - base) * stride + self.width]
            ids = index.term_ids(passage)
            for d, _ in index.retrieve(np.unique(ids[ids >= 0]).tolist()):
                retrieved[owner].add(d)
                if d not in leaked[owner] and index.verified(d, passage, self.overlap):
                    leaked[owner].add(d)
        self.clear()


def judged(index: Index, texts: list[str | None], overlap: float) -> tuple[list[set], list[set]]:
    """For each text the items retrieved by some passage, and those verified."""
    retrieved, leaked = [set() for _ in texts], [set() for _ in texts]
    batch = _Batch(index, overlap)
    for owner, text in enumerate(texts):
        text, at, carry = text or "", 0, []
        while at < len(text):
            end = at + CHARS
            if end < len(text):
                # a chunk ends where a word does
                found = re.compile(r"\W").search(text, end)
                end = found.start() if found else len(text)
            words = carry + words_of(text[at:end].lower())
            at = end
            if at < len(text):
                # the windows that reach beyond this chunk begin anew with the next one
                done = max(0, (len(words) - batch.width) // batch.stride) * batch.stride
                carry, words = words[done:], words[: done + batch.width]
                if not done:
                    continue
            batch.add(owner, words)
            if batch.size > BATCH_WORDS:
                batch.judge(retrieved, leaked)
    batch.judge(retrieved, leaked)
    return retrieved, leaked


def _worded(benchmark: DataFrame, slices: int) -> DataFrame:
    """(_slice, item_id, text, n_words, terms) of every item with words, written; `terms` are its distinct words."""
    items = benchmark.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)).cast("int").alias("_slice"), F.col("item_id").cast("bigint").alias("item_id"), "text")

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            known = [as_item(i, t) for i, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            sizes = pa.array([len(x.words) if x else 0 for x in known], pa.int64())
            terms = pa.array([sorted(set(x.words)) if x else [] for x in known], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, terms], names=[*batch.schema.names, "n_words", "terms"])

    schema = T.StructType([*items.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType()))])
    return materialise(items.mapInArrow(step, schema).filter("n_words > 0"), "test-items")


def leaks(docs: DataFrame, text: str, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """Add `retrieved` and `leaked` (sorted item ids) to every row; columns of these names are replaced.

    `benchmark` has item_id and text. Its items are taken in slices of SLICE, chosen by hash; every slice
    is scored with the statistics of all items. An empty benchmark leaves both columns empty.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("retrieved", "leaked")])
    out = docs.withColumn("retrieved", F.array().cast("array<bigint>")).withColumn("leaked", F.array().cast("array<bigint>"))
    benchmark = benchmark.filter("item_id is not null and text is not null")
    slices = -(-benchmark.count() // SLICE)
    if not slices:
        return out
    items = _worded(benchmark, slices)
    whole = items.agg(F.count(F.lit(1)).alias("items"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest")).first()
    # one row per word and slice, so the window over a word holds `slices` rows at most
    by_slice = items.select("_slice", F.explode("terms").alias("term")).groupBy("_slice", "term").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(by_slice.withColumn("df", F.sum("n").over(Window.partitionBy("term"))), "test-words")
    for i in range(slices):
        # bounded: a slice's share of the items, and their words
        rows = sorted((r["item_id"], r["text"]) for r in items.filter(F.col("_slice") == i).select("item_id", "text").collect())
        if rows:
            df = {r["term"]: r["df"] for r in counts.filter(F.col("_slice") == i).select("term", "df").collect()}
            stats = Statistics(whole["items"], whole["words"], whole["longest"], df)
            out = out.mapInArrow(_judge_step([as_item(*r) for r in rows], stats, text, threshold, overlap), out.schema)
    return out


def _judge_step(items: list[Item], stats: Statistics, text: str, threshold: float, overlap: float):
    def step(batches):
        import pyarrow as pa

        index = Index(items, threshold, stats)
        name = [x.item_id for x in items]
        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
                retrieved, leaked = judged(index, column(text), overlap)
                merged = {}
                for c, found in (("retrieved", retrieved), ("leaked", leaked)):
                    merged[c] = pa.array([sorted([*old, *(name[d] for d in new)]) for old, new in zip(column(c), found)], pa.list_(pa.int64()))
                arrays = [merged.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)]
                yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return step
