"""Maximum likelihood of the BG/NBD purchase model, for every scope at once.

A customer counts only through x repeat purchases, the time t_x of the last one and the age T, so the
customers are compressed to counts of (scope, x, t_x, T). Each round evaluates log-likelihood, gradient and
Hessian of all scopes as distributed sums over these counts; a table with one row per scope carries the
parameters from round to round. Parameters are searched on the log scale, where they are free, by Newton
steps with Levenberg damping; a step that lowers the likelihood is taken back.
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

PARAMETERS = ["r", "alpha", "a", "b"]
ROUNDS = 200
FLAT = 1e-9  # gradient per customer, on the log scale, at which a fit is done
SETTLED = 1e-9  # gain of log-likelihood per customer below which a step that still moves has no finite maximum ahead
LEAST_REPEATERS = 3
EXTREME = 7.0  # log distance from the start beyond which a parameter only means "none" or "all"
N_SUMS = 1 + 4 + 16  # likelihood, gradient, Hessian


def compressed(customers: DataFrame, scope: list[str]) -> DataFrame:
    """Counts of (scope, x, t_x, T) from f_value, r_value and customer_tenure_days; times in days."""
    age = F.col("customer_tenure_days")
    known = customers.filter(F.col("f_value").isNotNull() & F.col("r_value").isNotNull() & age.isNotNull())
    return known.groupBy(
        *scope, (F.col("f_value") - 1).cast("long").alias("x"), (age - F.col("r_value")).cast("long").alias("t_x"), age.cast("long").alias("age")
    ).agg(F.count(F.lit(1)).alias("n"))


def _functions():
    """ln gamma, digamma and trigamma of arrays of positive numbers: asymptotic series after a shift by eight."""
    import numpy as np

    def shifted(z):
        return z + 8.0, [z + j for j in range(8)]

    def log_gamma(z):
        w, below = shifted(z)
        return (w - 0.5) * np.log(w) - w + 0.5 * np.log(2 * np.pi) + 1 / (12 * w) - 1 / (360 * w**3) + 1 / (1260 * w**5) - 1 / (1680 * w**7) - sum(np.log(v) for v in below)

    def digamma(z):
        w, below = shifted(z)
        return np.log(w) - 1 / (2 * w) - 1 / (12 * w**2) + 1 / (120 * w**4) - 1 / (252 * w**6) - sum(1 / v for v in below)

    def trigamma(z):
        w, below = shifted(z)
        return 1 / w + 1 / (2 * w**2) + 1 / (6 * w**3) - 1 / (30 * w**5) + 1 / (42 * w**7) + sum(1 / v**2 for v in below)

    return log_gamma, digamma, trigamma


def terms(x, t_x, age, r, alpha, a, b):
    """Rows of 21 numbers for arrays of customers: log-likelihood, its gradient and Hessian in (r, alpha, a, b)."""
    import numpy as np

    log_gamma, digamma, trigamma = _functions()
    again = x > 0
    u = np.where(again, b + x - 1, 1.0)
    now, then = alpha + age, alpha + t_x
    l, k = np.log(now / then), 1 / now - 1 / then
    with np.errstate(over="ignore"):
        odds = np.where(again, np.log(a) - np.log(u) + (r + x) * l, -np.inf)
        p = 1 / (1 + np.exp(-odds))
    w = p * (1 - p)
    value = log_gamma(r + x) - log_gamma(r) + r * np.log(alpha) - (r + x) * np.log(now) + np.logaddexp(0, odds)
    value = value + log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)
    both = digamma(a + b) - digamma(a + b + x)
    d = [l, (r + x) * k, 1 / a, -1 / u]  # of the log odds that the customer left after the last purchase
    gradient = [
        digamma(r + x) - digamma(r) + np.log(alpha) - np.log(now) + p * d[0],
        r / alpha - (r + x) / now + p * d[1],
        both + p * d[2],
        digamma(b + x) - digamma(b) + both + p * d[3],
    ]
    bent = trigamma(a + b) - trigamma(a + b + x)
    zero = np.zeros_like(l)
    second = {
        (0, 0): trigamma(r + x) - trigamma(r),
        (0, 1): 1 / alpha - 1 / now + p * k,
        (1, 1): -r / alpha**2 + (r + x) / now**2 + p * (r + x) * (1 / then**2 - 1 / now**2),
        (2, 2): bent - p / a**2,
        (2, 3): bent,
        (3, 3): trigamma(b + x) - trigamma(b) + bent + p / u**2,
    }
    hessian = [second.get((min(i, j), max(i, j)), zero) + w * d[i] * d[j] for i in range(4) for j in range(4)]
    return np.stack(np.broadcast_arrays(value, *gradient, *hessian), axis=1)


def _partial_sums(unit: float):
    """Arrow step: the sums of one batch for each scope in it."""

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            scopes, at = np.unique(batch.column("_s").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            read = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(float)
            rows = terms(read("x"), read("t_x") / unit, read("age") / unit, *[read(p) for p in PARAMETERS]) * read("n")[:, None]
            sums = np.zeros((len(scopes), N_SUMS))
            np.add.at(sums, at, rows)
            yield pa.RecordBatch.from_arrays([pa.array(scopes.astype(object), pa.string()), *[pa.array(sums[:, i]) for i in range(N_SUMS)]], names=["_s", *[f"_{i}" for i in range(N_SUMS)]])

    return step


STATE = "_s string, n double, home array<double>, best array<double>, at array<double>, sums array<double>, damping double, slope double, rounds int, done boolean"


def _advance(penalty: float):
    """Arrow step: judge the point `at` by its sums and choose the next one, for each scope."""
    import numpy as np

    def next_row(row):
        now, n = np.array(row["new"]), row["n"]
        away = np.array(row["at"]) - np.array(row["home"])
        now[0] -= penalty * n * (away**2).sum()
        keep = row["sums"] is None or (np.isfinite(now).all() and now[0] >= row["sums"][0] - 1e-12 * abs(row["sums"][0]))
        best = np.array(row["at"] if keep else row["best"])
        sums = now if keep else np.array(row["sums"])
        damping = row["damping"] * (0.2 if keep else 8.0)
        theta = np.exp(best)
        plain = theta * sums[1:5]
        slope = plain - 2 * penalty * n * (best - np.array(row["home"]))
        crept = keep and row["sums"] is not None and now[0] - row["sums"][0] <= SETTLED * n
        done = bool(crept or np.abs(slope).max() <= FLAT * n or damping > 1e12 or row["rounds"] + 1 >= ROUNDS)
        curve = 2 * penalty * n * np.eye(4) - theta[:, None] * theta * sums[5:].reshape(4, 4) - np.diag(plain)
        scale = np.abs(np.diag(curve)) + 1e-9 * n
        # the least eigenvalue of the scaled curve must be positive for a step uphill
        low = np.linalg.eigvalsh(curve / np.sqrt(np.outer(scale, scale))).min()
        step = np.linalg.solve(curve + (max(0.0, -low) * 1.1 + damping) * np.diag(scale), slope)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-300))
        return {**row, "slope": float(np.abs(slope).max()), "best": list(best), "at": list(best if done else best + step), "sums": list(sums), "damping": damping, "rounds": row["rounds"] + 1, "done": done}

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [row if row["done"] else next_row(row) for row in batch.to_pylist()]
            kinds = {"string": pa.string(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()), "int": pa.int32(), "boolean": pa.bool_()}
            fields = [f.split(" ") for f in STATE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[k]) for c, k in fields], names=[c for c, _ in fields])

    return step


def fit_lifetime(customers: DataFrame, scope: list[str], unit_days: float = 7.0, penalty: float = 0.0) -> DataFrame:
    """One row per scope: r, alpha, a, b, log_likelihood, customers, rounds and fit_status.

    `fitted`; `boundary` (the likelihood hardly grows, yet parameters still move: customers who never leave,
    or all buy at one rate); `not_converged`; or `insufficient_rows` (fewer than three customers who came
    back; no parameters). Time is counted in units of `unit_days`. `penalty` per customer on the squared log
    distance from a plain start (rate as observed, all other parameters near one) gives every scope a finite
    and single maximum.
    """
    key = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(scope)]))
    counts = materialise(compressed(customers, scope).withColumn("_s", key), "lifetime-counts")
    facts = materialise(
        counts.groupBy("_s", *scope).agg(
            F.sum("n").alias("customers"),
            F.sum(F.when(F.col("x") > 0, F.col("n")).otherwise(0)).alias("repeaters"),
            (F.sum(F.col("n") * F.col("age")) / F.sum("n") / unit_days).alias("mean_age"),
            (F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("mean_x"),
        ),
        "lifetime-scopes",
    )
    able = F.col("repeaters") >= LEAST_REPEATERS
    start = F.array(F.lit(0.0), F.log(F.greatest(F.col("mean_age"), F.lit(1.0)) / F.greatest(F.col("mean_x"), F.lit(0.1))), F.lit(0.0), F.lit(0.5))
    none = F.lit(None).cast("array<double>")
    state = facts.filter(able).select(
        "_s", F.col("customers").cast("double").alias("n"), start.alias("home"), none.alias("best"), start.alias("at"), none.alias("sums"),
        F.lit(0.05).alias("damping"), F.lit(None).cast("double").alias("slope"), F.lit(0).alias("rounds"), F.lit(False).alias("done"),
    )
    state = materialise(state, "lifetime-state")
    narrow = counts.select(F.col("_s").alias("_k"), "x", "t_x", "age", "n")
    partial = T.StructType([T.StructField("_s", T.StringType()), *[T.StructField(f"_{i}", T.DoubleType()) for i in range(N_SUMS)]])
    joined_type = T.StructType([*state.schema.fields, T.StructField("new", T.ArrayType(T.DoubleType()))])
    while not state.filter(~F.col("done")).isEmpty():
        tried = state.filter(~F.col("done")).select("_s", *[F.exp(F.col("at")[i]).alias(p) for i, p in enumerate(PARAMETERS)])
        rows = narrow.join(tried, F.col("_k") == F.col("_s")).drop("_k")
        sums = rows.mapInArrow(_partial_sums(unit_days), partial).groupBy("_s").agg(F.array(*[F.sum(f"_{i}") for i in range(N_SUMS)]).alias("new"))
        state = materialise(state.join(sums, "_s", "left").select(*[f.name for f in joined_type]).mapInArrow(_advance(penalty), STATE), "lifetime-state")
    solved = state.select(
        F.col("_s").alias("_k"), *[F.exp(F.col("best")[i]).alias(p) for i, p in enumerate(PARAMETERS)], F.col("sums")[0].alias("log_likelihood"), "rounds", F.col("slope").alias("_slope"),
        F.greatest(*[F.abs(F.col("best")[i] - F.col("home")[i]) for i in range(4)]).alias("_away"),
    )
    status = (
        F.when(F.col("_k").isNull(), "insufficient_rows")
        .when(F.col("rounds") >= ROUNDS, "not_converged")
        .when((F.col("_slope") <= 1e-5 * F.col("customers")) & (F.col("_away") < EXTREME), "fitted")
        .otherwise("boundary")
    )
    return facts.join(solved, F.col("_s") == F.col("_k"), "left").select(*scope, "customers", *PARAMETERS, "log_likelihood", "rounds", status.alias("fit_status"))
