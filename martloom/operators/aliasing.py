"""Predictors that repeat others: rank-revealing elimination of one Gram matrix per product line.

The cross-products of the standardised predictors are summed over the rows that have all of them, batch by
batch and then by line; one small matrix per line is eliminated in the order the predictors are listed. A
predictor of which nearly nothing is left after the earlier ones is a linear combination of them.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.poisson import MODEL, finite
from martloom.session import materialise, sized

# the steps travel to executors with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEFT = 1e-9  # share of a predictor's variance that must be left for it to count as its own


def _gram(p: int):
    """Arrow step: for each line in a batch the sums of products of its rows of `z`."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("product_line_id").to_numpy(zero_copy_only=False).astype(str)
            z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            lines = sorted(set(names))
            sums = [(z[names == line].T @ z[names == line]).ravel() for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(sums, pa.list_(pa.float64()))], names=["product_line_id", "sums"])

    return step


def eliminated(gram, left: float = LEFT) -> list[int]:
    """Numbers of the columns that are combinations of earlier ones; columns of zeros aren't judged."""
    import numpy as np

    work, own = np.array(gram, dtype=float), np.diag(gram).copy()
    gone = []
    for j in range(len(work)):
        if own[j] <= 0:
            continue
        if work[j, j] <= left * own[j]:
            gone.append(j)
            continue
        work = work - np.outer(work[:, j], work[j]) / work[j, j]
    return gone


def _eliminate(predictors: list[str]):
    def step(batches):
        import numpy as np
        import pyarrow as pa

        p = len(predictors)
        for batch in batches:
            rows = [
                (line, predictors[j])
                for line, sums in zip(batch.column("product_line_id").to_pylist(), batch.column("sums").to_pylist())
                for j in eliminated(np.array(sums).reshape(p, p))
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=MODEL)

    return step


def aliased(df: DataFrame, predictors: list[str]) -> DataFrame:
    """(product_line_id, predictor) of the predictors that repeat earlier ones in their line.

    Predictors without a value or without variance in a line take no part there. Rows that lack any of the
    others are left out.
    """
    values = [finite(F.col(f"`{p}`")) for p in predictors]
    rows = materialise(df.select("product_line_id", F.array(*values).alias("x")).filter("product_line_id is not null"), "alias-rows")
    at = lambda i: F.col("x")[i]
    some = rows.groupBy("product_line_id").agg(F.array(*[F.coalesce(F.max(at(i)) > F.min(at(i)), F.lit(False)) for i in range(len(predictors))]).alias("varies"))
    whole = rows.join(sized(some), "product_line_id").filter(F.forall(F.arrays_zip("x", "varies"), lambda v: ~v["varies"] | v["x"].isNotNull()))
    whole = materialise(whole, "whole-rows")
    moments = whole.groupBy("product_line_id").agg(
        F.array(*[F.avg(at(i)) for i in range(len(predictors))]).alias("mean"), F.array(*[F.stddev_pop(at(i)) for i in range(len(predictors))]).alias("sd")
    )
    joined = whole.join(sized(moments), "product_line_id")
    z = [F.when(F.col("varies")[i] & (F.col("sd")[i] > 0), (at(i) - F.col("mean")[i]) / F.col("sd")[i]).otherwise(0.0) for i in range(len(predictors))]
    partial = joined.select("product_line_id", F.array(*z).alias("z")).mapInArrow(_gram(len(predictors)), "product_line_id string, sums array<double>")
    long = partial.select("product_line_id", F.posexplode("sums").alias("i", "s")).groupBy("product_line_id", "i").agg(F.sum("s").alias("s"))
    # topics^2 numbers per line
    grams = long.groupBy("product_line_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda r: r["s"]).alias("sums"))
    return grams.mapInArrow(_eliminate(predictors), "product_line_id string, predictor string")


def with_structure(gate: DataFrame, df: DataFrame, requested: list[str]) -> DataFrame:
    """The estimability table, plus `missing_column` rows and `aliased` in place of `estimated`.

    `requested` lists predictors in order of preference; those that `df` lacks are reported for every line.
    """
    present = [p for p in requested if p in df.columns]
    gone = aliased(df, present).withColumn("_aliased", F.lit(True))
    marked = gate.join(sized(gone), MODEL, "left")
    hit = F.col("_aliased") & (F.col("estimation_status") == "estimated")
    marked = marked.withColumn("drop_reason", F.when(hit, "aliased").otherwise(F.col("drop_reason"))).withColumn(
        "estimation_status", F.when(hit, "not_estimable").otherwise(F.col("estimation_status"))
    )
    absent = [p for p in requested if p not in df.columns]
    lines = df.select("product_line_id").distinct()
    rows = lines.select(
        "product_line_id",
        F.explode(F.array(*[F.lit(p) for p in absent]).cast("array<string>")).alias("predictor"),
        F.lit(0).cast("long").alias("sample_size"),
        F.lit(0).cast("long").alias("n_levels"),
        F.lit("not_estimable").alias("estimation_status"),
        F.lit("missing_column").alias("drop_reason"),
    )
    return marked.drop("_aliased").unionByName(rows)
