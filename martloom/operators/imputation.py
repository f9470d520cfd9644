"""Missing item ratings by chained equations: m chains of seeded regression draws, pooled.

Every item of a line gets one row with all topics of the line, so nothing is lost, not even items that
nobody rated. Each round reads the completed rows once: for every (line, chain, topic) it sums the
cross-moments of the rows in which the topic was observed, draws a regression of the topic on all others from
them, and then redraws each missing value, topic by topic, from its regression. Draws depend on the seed, line,
chain, round, topic and item only, never on the layout of the data.

Sums grow with lines x chains x topics^3 and the drawn regressions with lines x chains x topics^2; topics are a
configured list per line, not data. Only the regressions return to the driver, to be handed to all tasks.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import materialise, sized

# the steps travel to executors with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RIDGE = 1e-5  # share of the diagonal added before a regression is solved


def grid(ratings: DataFrame, items: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per item: `vals` has the item's mean rating (or null) for each topic of its line, in order of name."""
    named = sized(topics.groupBy("product_line_id").agg(F.array_sort(F.collect_set("topic")).alias("topics")))
    rated = ratings.filter("rating is not null").groupBy("product_line_id", "product_id", "topic").agg(F.avg("rating").alias("rating"))
    rated = rated.groupBy("product_line_id", "product_id").agg(F.map_from_entries(F.collect_list(F.struct("topic", "rating"))).alias("_known"))
    every = items.select("product_line_id", "product_id").distinct().join(named, "product_line_id").join(rated, ["product_line_id", "product_id"], "left")
    return every.select(
        "product_line_id", "product_id", "topics", F.transform("topics", lambda t: F.try_element_at("_known", t)).alias("vals")
    )


def _normals(ids, *key):
    """Standard normals from a 64-bit mix of (id, key), two uniforms each."""
    import numpy as np

    def mixed(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    with np.errstate(over="ignore"):
        state = ids.astype(np.int64).view(np.uint64)
        for part in key:
            state = mixed(state + np.uint64(0x9E3779B97F4A7C15) * np.uint64(part + 1))
        one, two = mixed(state + np.uint64(1)), mixed(state + np.uint64(2))
    unit = lambda v: ((v >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
    return np.sqrt(-2 * np.log(unit(one))) * np.cos(2 * np.pi * unit(two))


def _matrix(column, width: int):
    """A list column as rows x width, nulls as NaN."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width) if width else np.zeros((len(column), 0))


def _lines(batch):
    """(line, row numbers, topics) of the lines in a batch."""
    import numpy as np

    coded = batch.column("product_line_id").dictionary_encode()
    names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    widths = batch.column("vals").value_lengths().to_numpy(zero_copy_only=False)
    for code in sorted(range(len(names)), key=names.__getitem__):
        rows = np.flatnonzero(codes == code)
        yield names[code], rows, int(widths[rows[0]])


class _Filled:
    """The list column of all chains of a batch, filled line by line."""

    def __init__(self, batch, m: int):
        import numpy as np

        widths = batch.column("vals").value_lengths().to_numpy(zero_copy_only=False)
        self.ends = np.concatenate([[0], np.cumsum(widths.astype(np.int64) * m)])
        self.flat = np.empty(self.ends[-1])

    def put(self, rows, chains) -> None:
        import numpy as np

        full = chains.reshape(len(rows), -1)
        self.flat[self.ends[rows][:, None] + np.arange(full.shape[1])] = full

    def column(self):
        import pyarrow as pa

        return pa.ListArray.from_arrays(pa.array(self.ends.astype("int32")), pa.array(self.flat))


def _started(marks: dict, m: int, seed: int):
    """First fill of the gaps: the topic's mean and scatter in the line, else over all lines."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            filled = _Filled(batch, m)
            for line, rows, p in _lines(batch):
                part = batch.take(pa.array(rows))
                vals, ids = _matrix(part.column("vals"), p), part.column("_id").to_numpy(zero_copy_only=False)
                chains = np.repeat(vals[:, None, :], m, axis=1)
                for j in range(p):
                    mean, sd, low, high = marks[line][j]
                    gap = np.isnan(vals[:, j])
                    for c in range(m):
                        chains[gap, c, j] = np.clip(mean + sd * _normals(ids[gap], seed, c, 0, j), low, high)
                filled.put(rows, chains)
            names = [*batch.schema.names, "chains"]
            yield pa.RecordBatch.from_arrays([*batch.columns, filled.column()], names=names)

    return step


def _moments(m: int):
    """Sums over one batch: for each line, chain and topic the cross-moments of the rows that observed the topic."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lines, sums = [], []
            for line, rows, p in _lines(batch):
                part = batch.take(pa.array(rows))
                known = ~np.isnan(_matrix(part.column("vals"), p))
                chains = _matrix(part.column("chains"), m * p).reshape(len(rows), m, p)
                with_one = np.concatenate([np.ones((len(rows), m, 1)), chains], axis=2)
                found = np.einsum("nj,nca,ncb->cjab", known.astype(float), with_one, with_one, optimize=True)
                lines.append(line)
                sums.append(found.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(sums, pa.list_(pa.float64()))], names=["product_line_id", "sums"])

    return step


def _drawn(m: int, seed: int, turn: int):
    """Regressions drawn from the summed moments of each line: m x p rows of intercept, slopes (own slope 0) and scatter."""

    def regression(moments, j, rng):
        import numpy as np

        p = moments.shape[0] - 1
        use = [k for k in range(p + 1) if k != j + 1]
        n = moments[0, 0]
        out = np.zeros(p + 2)
        if n < 1:
            return out
        xx, xy, yy = moments[np.ix_(use, use)], moments[use, j + 1], moments[j + 1, j + 1]
        bent = xx + np.diag(np.diag(xx) + n * 1e-3) * RIDGE
        beta = np.linalg.solve(bent, xy)
        rest = max(float(yy - 2 * beta @ xy + beta @ xx @ beta), 0.0)
        sigma = np.sqrt(rest / max(rng.chisquare(max(n - len(use), 1)), 1e-9))
        sigma = min(sigma, np.sqrt(max(yy / n - (moments[0, j + 1] / n) ** 2, 0.0)))  # never wider than the topic itself
        beta = beta + sigma * np.linalg.cholesky(np.linalg.inv(bent) + 1e-12 * np.eye(len(use))) @ rng.standard_normal(len(use))
        out[use] = beta
        out[p + 1] = sigma
        return out

    def step(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            drawn = []
            for line, p, sums in zip(batch.column("product_line_id").to_pylist(), batch.column("p").to_pylist(), batch.column("sums").to_pylist()):
                moments = np.array(sums).reshape(m, p, p + 1, p + 1)
                rng = lambda c, j: np.random.default_rng([seed, zlib.crc32(line.encode()), turn, c, j])
                drawn.append(np.concatenate([regression(moments[c, j], j, rng(c, j)) for c in range(m) for j in range(p)]))
            yield pa.RecordBatch.from_arrays([batch.column("product_line_id"), pa.array(drawn, pa.list_(pa.float64()))], names=["product_line_id", "drawn"])

    return step


def _redrawn(models, marks: dict, m: int, seed: int, turn: int):
    """Replace the missing values of each row, topic by topic, by draws from the regressions."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            filled = _Filled(batch, m)
            for line, rows, p in _lines(batch):
                part = batch.take(pa.array(rows))
                gaps = np.isnan(_matrix(part.column("vals"), p))
                ids = part.column("_id").to_numpy(zero_copy_only=False)
                chains = _matrix(part.column("chains"), m * p).reshape(len(rows), m, p).copy()
                drawn = np.array(models.value[line]).reshape(m, p, p + 2)
                for j in range(p):
                    gap = gaps[:, j]
                    _, _, low, high = marks[line][j]
                    if not gap.any() or low > high:
                        continue
                    for c in range(m):
                        fit = drawn[c, j, 0] + chains[gap, c, :] @ drawn[c, j, 1 : p + 1]
                        # a topic nobody rated in this line has no regression and keeps its first fill
                        if drawn[c, j].any():
                            chains[gap, c, j] = np.clip(fit + drawn[c, j, p + 1] * _normals(ids[gap], seed, c, turn, j), low, high)
                filled.put(rows, chains)
            kept = [batch.column(n) for n in batch.schema.names if n != "chains"]
            names = [n for n in batch.schema.names if n != "chains"]
            yield pa.RecordBatch.from_arrays([*kept, filled.column()], names=[*names, "chains"])

    return step


def _marks(rows: DataFrame) -> dict:
    """For each line its topics' (mean, deviation, least, largest) rating; topics unrated in the line take those of all lines."""
    long = rows.select("product_line_id", "topics", F.posexplode("vals").alias("j", "v")).withColumn("topic", F.element_at("topics", F.col("j") + 1))
    stats = [F.avg("v").alias("mean"), F.coalesce(F.stddev("v"), F.lit(0.0)).alias("sd"), F.min("v").alias("low"), F.max("v").alias("high")]
    overall = {r["topic"]: r for r in long.groupBy("topic").agg(*stats).collect()}
    marks: dict[str, list] = {}
    for r in long.groupBy("product_line_id", "j", "topic").agg(*stats).orderBy("product_line_id", "j").collect():
        best = r if r["mean"] is not None else overall[r["topic"]]
        known = best["mean"] is not None
        marks.setdefault(r["product_line_id"], []).append((best["mean"], best["sd"], best["low"], best["high"]) if known else (float("nan"), 0.0, float("nan"), float("nan")))
    return marks


def impute_chained(ratings: DataFrame, items: DataFrame, topics: DataFrame, m: int = 5, rounds: int = 20, seed: int = 500) -> DataFrame:
    """(product_line_id, product_id, topic, rating, imputed, spread) for every item of `items` and topic of its line.

    Observed means stay as they are. A missing one is the mean over the chains after the last round, inside the
    topic's observed range; `spread` is the deviation between chains. A topic that nobody rated anywhere stays null.
    """
    rows = grid(ratings, items, topics).withColumn("_id", F.xxhash64("product_line_id", "product_id"))
    rows = materialise(rows, "rating-grid")
    marks = _marks(rows)
    # a topic without any rating takes no part in the regressions
    dead = {line: [j for j, mark in enumerate(found) if mark[0] != mark[0]] for line, found in marks.items()}
    marks = {line: [(0.0, 0.0, 0.0, 0.0) if mark[0] != mark[0] else mark for mark in found] for line, found in marks.items()}
    spark = rows.sparkSession
    state_type = T.StructType([*rows.schema.fields, T.StructField("chains", T.ArrayType(T.DoubleType()))])
    state = materialise(rows.mapInArrow(_started(marks, m, seed), state_type), "chains")
    for turn in range(1, rounds + 1):
        sums = state.mapInArrow(_moments(m), "product_line_id string, sums array<double>")
        long = sums.select("product_line_id", F.posexplode("sums").alias("i", "s")).groupBy("product_line_id", "i").agg(F.sum("s").alias("s"))
        whole = long.groupBy("product_line_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda r: r["s"]).alias("sums"))
        widths = spark.createDataFrame([(line, len(found)) for line, found in marks.items()], "product_line_id string, p int")
        drawn = whole.join(widths, "product_line_id").mapInArrow(_drawn(m, seed, turn), "product_line_id string, drawn array<double>")
        models = spark.sparkContext.broadcast({r["product_line_id"]: r["drawn"] for r in drawn.collect()})
        state = materialise(state.mapInArrow(_redrawn(models, marks, m, seed, turn), state_type), "chains")
    width = F.size("topics")
    chain = lambda j: F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda c: F.element_at("chains", c * width + j + 1))
    long = state.select("product_line_id", "product_id", "topics", "chains", F.posexplode("vals").alias("j", "v"))
    mean = F.aggregate(chain(F.col("j")), F.lit(0.0), lambda a, v: a + v) / m
    long = long.withColumn("_mean", mean)
    scatter = F.sqrt(F.aggregate(chain(F.col("j")), F.lit(0.0), lambda a, v: a + (v - F.col("_mean")) * (v - F.col("_mean"))) / max(m - 1, 1))
    unknown = F.lit(False)
    for line, gaps in dead.items():
        if gaps:
            unknown = unknown | ((F.col("product_line_id") == line) & F.col("j").isin(gaps))
    missing = F.col("v").isNull()
    return long.select(
        "product_line_id",
        "product_id",
        F.element_at("topics", F.col("j") + 1).alias("topic"),
        F.when(~missing, F.col("v")).when(~unknown, F.col("_mean")).alias("rating"),
        missing.alias("imputed"),
        F.when(missing & ~unknown, scatter).alias("spread"),
    )
