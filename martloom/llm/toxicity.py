"""Toxicity by a chain of linear classifiers.

Categories are predicted in order; each later model sees, beside the text's terms, the probabilities of
all earlier categories. While it is trained these come from out-of-fold models, so that they are as
uncertain as they will be on new texts; for scoring, a model of each category is fitted to the whole
sample. Terms are the distinct lower-cased words of the whole text and their beginnings of three
to six characters, so that inflected or compounded forms share evidence.

The models are fitted on at most `sample` labelled rows (chosen by hash of the id) and use at most
`terms` terms, those whose presence differs most between classes. Everything else runs over all rows.
Null texts count as empty. A category without both classes in the sample gets its base rate, or zero
without any labelled row. Rows labelled twice count twice; null labels are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import exp

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import materialise

FOLDS = 3
PREFIXES = (3, 4, 5, 6)
MIN_ROWS = 5  # labelled rows a term must occur in

words_of = re.compile(r"\w+").findall


def terms_of(text: str | None) -> set[str]:
    words = set(words_of((text or "").lower()))
    found = set(words)
    for n in PREFIXES:
        found.update(["^" + w[:n] for w in words if len(w) > n])
    return found


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    bias: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]  # by term, one for each category
    links: tuple[tuple[float, ...], ...]  # of each category to the earlier ones

    def probabilities(self, text: str | None) -> list[float]:
        sums = list(self.bias)
        for term in terms_of(text) & self.weights.keys():
            for i, w in enumerate(self.weights[term]):
                sums[i] += w
        out: list[float] = []
        for total, links in zip(sums, self.links):
            total += sum(a * b for a, b in zip(links, out))
            out.append(1 / (1 + exp(-max(-60.0, min(60.0, total)))))
        return out


def _with_terms(rows: DataFrame, text: str, out: str) -> DataFrame:
    kept = [c for c in rows.columns if c != text]

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = pa.array([sorted(terms_of(t.as_py())) for t in batch.column(at)], pa.list_(pa.string()))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*kept, out])

    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(out, T.ArrayType(T.StringType()))])
    return rows.mapInArrow(step, schema)


def labelled_sample(docs: DataFrame, text: str, labels: DataFrame, ident: str, categories: dict[str, str], sample: int) -> DataFrame:
    """(_fold, _terms, one 0/1 column for each category) of at most `sample` labelled rows, by hash of `ident`."""
    names = list(categories)
    marks = labels.select(F.col(ident).alias("_id"), *[F.expr(rule).cast("double").alias(c) for c, rule in categories.items()])
    marks = marks.dropna().orderBy(F.xxhash64("_id"), "_id", *names).limit(sample)
    # at most `sample` rows of a few numbers each
    rows = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(marks), "_id")
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64("_id"), F.lit(FOLDS)).cast("int"))
    return materialise(_with_terms(rows.select("_fold", "_text", *names), "_text", "_terms"), "labelled-terms")


def chosen_terms(rows: DataFrame, names: list[str], terms: int) -> list[str]:
    """The terms whose share of rows differs most between the classes of any category."""
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    n = sizes["n"]
    counts = rows.select(*names, F.explode("_terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names])
    gaps = []
    for c in names:
        ones = sizes[c] or 0.0
        if 0 < ones < n:
            # chi-square of presence against class
            share = F.col("n") * ones / n
            gaps.append((F.col(c) - share) * (F.col(c) - share) / (share * (1 - ones / n)))
    if not gaps:
        return []
    best = reduce(lambda a, b: F.greatest(a, b), gaps)
    kept = counts.filter(F.col("n") >= MIN_ROWS).orderBy(best.desc(), "term").limit(terms)
    return sorted(r["term"] for r in kept.select("term").collect())  # bounded by `terms`


def fit_chain(docs: DataFrame, text: str, labels: DataFrame, ident: str, categories: dict[str, str], sample: int = 20_000, terms: int = 4096) -> Chain:
    """`categories` maps each name, in chain order, to an SQL condition over `labels`."""
    names = list(categories)
    rows = labelled_sample(docs, text, labels, ident, categories, sample)
    vocabulary = chosen_terms(rows, names, terms)
    spark = rows.sparkSession
    total = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    weights: dict[str, list[float]] = {t: [] for t in vocabulary}
    bias, links = [], []
    if vocabulary:
        counter = CountVectorizerModel.from_vocabulary(vocabulary, "_terms", "_vec")
        counter.setBinary(True)
        rows = materialise(counter.transform(rows).drop("_terms"), "labelled-vectors")
    for i, name in enumerate(names):
        ones = total[name] or 0.0
        if not vocabulary or not 0 < ones < total["n"]:
            rate = ones / total["n"] if total["n"] else 0.0
            bias.append(60.0 if rate >= 1 else -60.0)
            links.append((0.0,) * i)
            for w in weights.values():
                w.append(0.0)
            if vocabulary:
                rows = rows.withColumn(f"_p_{name}", F.lit(rate))
            continue
        inputs = ["_vec", *[f"_p_{c}" for c in names[:i]]]
        ready = VectorAssembler(inputCols=inputs, outputCol="_x").transform(rows)
        learner = LogisticRegression(featuresCol="_x", labelCol=name, regParam=0.03, maxIter=60, probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_raw")
        model = learner.fit(ready)
        values = model.coefficients.toArray().tolist()
        for t, w in zip(vocabulary, values):
            weights[t].append(w)
        links.append(tuple(values[len(vocabulary) :]))
        bias.append(float(model.intercept))
        if i + 1 < len(names):
            parts = []
            for fold in range(FOLDS):
                other = ready.filter(F.col("_fold") != fold)
                held = ready.filter(F.col("_fold") == fold)
                both = other.agg(F.min(name), F.max(name)).first()
                if both[0] == both[1]:
                    part = held.withColumn(f"_p_{name}", F.lit(float(both[0] or 0.0)))
                else:
                    fitted = learner.fit(other)
                    part = fitted.transform(held).withColumn(f"_p_{name}", vector_to_array("_prob")[1])
                parts.append(part.select(*rows.columns, f"_p_{name}"))
            rows = materialise(reduce(DataFrame.unionByName, parts), "out-of-fold")
    return Chain(tuple(names), tuple(bias), {t: tuple(w) for t, w in weights.items()}, tuple(links))


def scored(docs: DataFrame, text: str, chain: Chain, prefix: str = "p_") -> DataFrame:
    """Add one probability column for each category; columns of these names are replaced."""
    names = [prefix + c for c in chain.categories]
    docs = docs.select(*[c for c in docs.columns if c not in names])

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = [chain.probabilities(t.as_py()) for t in batch.column(at)]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return docs.mapInArrow(step, T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]]))
