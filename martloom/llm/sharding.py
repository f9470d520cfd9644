"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows get numbers 0 .. n-1 in a fixed order; a keyed bijection of that range gives each row its
shuffled place, and `place % shards`, `place // shards` are its shard and slot. Shard sizes differ
by one row at most, slots have no gaps, and either direction is computable from one number
without looking at any other row.

The Feistel network works on a rectangle `rows x cols` that is just large enough for n, so fewer
than `rows` of its cells lie outside the range; a value that lands there walks on along its cycle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.ordering import ranked

ROUNDS = 4
PRIME = 2_147_483_647  # every product below stays under 2^62
MULTIPLIERS = (48_271, 16_807)  # of the two mixing steps


def round_keys(seed: int) -> list[int]:
    """One additive key for each round, from the seed by a linear congruence."""
    keys, state = [], (seed * 1_000_003 + 12_345) % PRIME
    for _ in range(ROUNDS):
        state = (state * 69_621 + 7) % PRIME
        keys.append(state)
    return keys


def rectangle(n: int) -> tuple[int, int]:
    rows = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return rows, max(1, -(-n // rows))


def _mixed(half: Column, key: int) -> Column:
    first = ((half + F.lit(key)) % PRIME) * MULTIPLIERS[0] % PRIME
    folded = first.bitwiseXOR(F.shiftright(first, 15))
    return (folded % PRIME) * MULTIPLIERS[1] % PRIME


def _once(place: Column, n: int, seed: int, inverse: bool) -> Column:
    """One pass of the network; expressions stay small enough for code generation."""
    rows, cols = rectangle(n)
    r, c = (place - place % cols) / F.lit(cols), place % cols
    r = r.cast("long")
    sign = F.lit(-1 if inverse else 1)
    steps = list(enumerate(round_keys(seed)))
    for i, key in reversed(steps) if inverse else steps:
        if i % 2 == 0:
            r = F.pmod(r + sign * (_mixed(c, key) % rows), F.lit(rows))
        else:
            c = F.pmod(c + sign * (_mixed(r, key) % cols), F.lit(cols))
    return r * F.lit(cols) + c


def permuted(place: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """The shuffled place of row number `place` in 0 .. n-1, or with `inverse` the row number of a place.

    A walk visits each outside cell once at most, so `outside + 1` steps always suffice; for large n
    the chance to need even ten is below any meaning, and a walk that didn't end raises an error.
    """
    rows, cols = rectangle(n)
    outside = rows * cols - n
    first = _once(place, n, seed, inverse)
    if not outside:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(outside, 64)))
    walked = F.aggregate(steps, first, lambda at, _: F.when(at < n, at).otherwise(_once(at, n, seed, inverse)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk didn't end")).cast("long"))


def sharded(docs: DataFrame, order: list[str], shards: int = 16, seed: int = 20, total: int | None = None) -> DataFrame:
    """Add `shard` and `slot` (long) to every row; rows are numbered by `order`.

    Only rows equal in all of `order` share a number's choice, and they are interchangeable. Nulls
    sort first. An empty table stays empty. Columns named `shard` or `slot` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    hidden = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # no clash with the columns added here
    plain = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()]).withColumn("_tie", F.monotonically_increasing_id())
    numbered = ranked(plain, [], [*[hidden[c] for c in order], "_tie"], "_row", "_rows")
    n = total if total is not None else numbered.agg(F.count(F.lit(1))).first()[0]
    placed = numbered.withColumn("_place", permuted(F.col("_row") - 1, max(n, 1), seed))
    slot = (F.col("_place") - F.col("_place") % shards) / shards
    return placed.select(*[F.col(hidden[c]).alias(c) for c in kept], (F.col("_place") % shards).cast("int").alias("shard"), slot.cast("long").alias("slot"))
