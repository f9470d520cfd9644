"""Exact ordered operators that never put a whole group into one task.

`row_number`, `ntile`, `lead` and running totals over `PARTITION BY g` send each group to a
single task. A roll-up group such as `all` holds every row, so these helpers lay rows out by
range over (group, order) instead: a large group spans many tasks, each task numbers its own
run, and a table with one row per (task, group) carries the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import attach_row, materialise, sized

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def _as_columns(names):
    return [F.col(c) if isinstance(c, str) else c for c in names]


def lay_out(df: DataFrame, group: list[str], order: list) -> DataFrame:
    """Range-partition and sort by (group, order); tag rows with task `_part` and position `_pos`.

    `order` must be a total order inside each group; that also keeps the ranges even when one
    group or one leading value holds a large share of the rows. The result is written once, so
    the tags cannot change when a task is retried.
    """
    keys = _as_columns(group) + _as_columns(order)
    laid = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_mid")
    )
    return materialise(laid, "ordered")


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def _join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left side's key columns."""
    tagged = right.select(*[F.col(c).alias(f"_k_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(tagged[f"_k_{c}"]) for c in cols])
    return left.join(tagged, cond, how).drop(*[f"_k_{c}" for c in cols])


def _carry(laid: DataFrame, group: list[str], measure: Column) -> DataFrame:
    """One row per (task, group): first position, own total and the total of earlier tasks.

    Windows here see at most one row per task for each group.
    """
    per = laid.groupBy("_part", *group).agg(F.min("_pos").alias("_first"), measure.alias("_own"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = per.select(
        "_part",
        *group,
        "_first",
        F.sum("_own").over(earlier).alias("_before"),
        F.sum("_own").over(w).alias("_total"),
    )
    return sized(placed)


def _local_runs(group: list[str], weight: str | None):
    """Arrow step over one sorted task: rows (and weight) of the current group so far, the row included."""

    def step(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, rows, total = None, 0, 0  # key of the row before this batch, its running values
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.zeros(n, dtype=bool)
            for c in group:
                col = batch.column(batch.schema.get_field_index(c))
                if n > 1:
                    one, two = col.slice(0, n - 1), col.slice(1)
                    differ = pc.fill_null(pc.not_equal(one, two), False)
                    differ = pc.or_(differ, pc.xor(pc.is_null(one), pc.is_null(two)))
                    starts[1:] |= differ.to_numpy(zero_copy_only=False)
            key = [batch.column(batch.schema.get_field_index(c))[0].as_py() for c in group]
            starts[0] = key != last
            last = [batch.column(batch.schema.get_field_index(c))[n - 1].as_py() for c in group]
            where = np.arange(n)
            begun = np.maximum.accumulate(np.where(starts, where, -1))
            local = where - np.maximum(begun, 0) + 1 + np.where(begun < 0, rows, 0)
            out = [pa.array(local, pa.int64())]
            rows = int(local[-1])
            if weight:
                w = batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(w)
                run = upto - np.where(begun < 0, 0, (upto - w)[np.maximum(begun, 0)]) + np.where(begun < 0, total, 0)
                out.append(pa.array(run, pa.int64()))
                total = int(run[-1])
            names = ["_rank", "_run"][: len(out)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *names])

    return step


def _task_of(df: DataFrame) -> DataFrame:
    mid = F.monotonically_increasing_id()
    return df.withColumn("_part", F.shiftright(mid, _POS_BITS)).withColumn("_pos", mid.bitwiseAND(F.lit((1 << _POS_BITS) - 1)))


def positions(df: DataFrame, group: list[str], order: list, rank: str = "rn", weight: str | None = None, run: str = "upto") -> DataFrame:
    """Add the row number inside each group and, with `weight` (a long without nulls), its running sum.

    One range shuffle, written once. Each task counts its own runs while it writes; only the group
    cut by a task border needs an offset, so the carry table has one row per task.
    """
    keys = _as_columns(group) + _as_columns(order)
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = _task_of(laid)
    if group or weight:
        added = "_rank long" + (", _run long" if weight else "")
        schema = T.StructType([*laid.schema.fields, *T._parse_datatype_string(added).fields])
        laid = laid.mapInArrow(_local_runs(group, weight), schema)
    else:
        laid = laid.withColumn("_rank", F.col("_pos") + F.lit(1))
    laid = materialise(laid, "ordered")
    key = F.struct(F.lit(0).alias("_k"), *group)
    sums = ["_rank"] + (["_run"] if weight else [])
    ends = laid.groupBy("_part").agg(
        F.min_by(key, "_pos").alias("_first"), F.max_by(key, "_pos").alias("_last"), *[F.max_by(c, "_pos").alias(c) for c in sums]
    )
    ends = materialise(ends, "task-ends")  # one row per task
    # tasks that end in a group are all before the one that begins in it and goes on, so one sum per group and one
    # running sum over its tasks place every piece; no task meets another
    earlier = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = ends.select("_part", "_first", "_last", *[F.sum(c).over(earlier).alias(f"_e{c}") for c in sums])
    totals = ends.groupBy(F.col("_last").alias("_g")).agg(*[F.sum(c).alias(f"_t{c}") for c in sums])
    whole = F.col("_first").eqNullSafe(F.col("_last"))
    offsets = within.join(totals, F.col("_first").eqNullSafe(F.col("_g"))).select(
        F.col("_part").alias("_p"), "_g", *[F.when(whole, F.col(f"_e{c}")).otherwise(F.col(f"_t{c}")).alias(f"_b{c}") for c in sums]
    )
    offsets = sized(offsets)
    joined = laid.withColumn("_key", key).join(offsets, (F.col("_part") == F.col("_p")) & F.col("_key").eqNullSafe(F.col("_g")), "left")
    outs = [(F.col("_rank") + F.coalesce("_b_rank", F.lit(0))).alias(rank)]
    if weight:
        outs.append((F.col("_run") + F.coalesce("_b_run", F.lit(0))).alias(run))
    return joined.select(*df.columns, *outs)


def ranked(df: DataFrame, group: list[str], order: list, out: str = "rn", size: str | None = None) -> DataFrame:
    """`row_number() over (partition by group order by order)`, exact; `size` adds the group count."""
    numbered = positions(df, group, order, out)
    if size is None:
        return numbered
    if not group:
        return attach_row(numbered, df.agg(F.count(F.lit(1)).alias(size)))
    counts = sized(df.groupBy(*group).agg(F.count(F.lit(1)).alias(size)))
    return _join_on(numbered, counts, group)


def running_total(df: DataFrame, group: list[str], order: list, value: str, out: str, total: str) -> DataFrame:
    """Inclusive running sum of `value` in order, plus the group total."""
    laid = lay_out(df, group, order)
    carry = _carry(laid, group, F.sum(value)).drop("_first")
    local = Window.partitionBy("_part", *group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = laid.withColumn("_run", F.sum(value).over(local))
    return (
        _join_on(summed, carry, ["_part", *group])
        .withColumn(out, F.col("_run") + F.coalesce("_before", F.lit(0)))
        .withColumnRenamed("_total", total)
        .drop("_part", "_pos", "_run", "_before")
    )


def _local_history(group: list[str], weight: str | None, since: str | None, nexts: list[str]):
    """Arrow step over one sorted task, row by row of the current group: rows, sum of `weight` and first value of `since`
    that is not null so far, columns of the group's next row, and whether the row is the task's first (1) or last (2)."""

    def step(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def column(batch, name):
            return batch.column(batch.schema.get_field_index(name))

        def key_at(batch, i):
            return [column(batch, c)[i].as_py() for c in group]

        def finished(batch, out, starts, edge, head):
            """The rows of a batch once the task's next row, the first of `head`, is known."""
            goes_on = head is not None and key_at(head, 0) == key_at(batch, batch.num_rows - 1)
            other = pa.array(np.append(starts[1:], not goes_on))
            if head is None:
                edge[-1] += 2
            following = []
            for c in nexts:
                col = column(batch, c)
                last = column(head, c).slice(0, 1) if goes_on else pa.nulls(1, col.type)
                following.append(pc.if_else(other, pa.scalar(None, col.type), pa.concat_arrays([col.slice(1), last])))
            arrays = [*out, *following, pa.array(edge)]
            names = ["_rank"] + ["_run"] * bool(weight) + ["_since"] * bool(since) + [f"_next_{c}" for c in nexts] + ["_edge"]
            return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])

        waiting, last, rows, total, early = None, None, 0, 0, None  # key of the row before this batch, its running values
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts, edge = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int32)
            if waiting is None:
                edge[0] = 1
            else:
                yield finished(*waiting, batch)
            for c in group:
                col = column(batch, c)
                if n > 1:
                    one, two = col.slice(0, n - 1), col.slice(1)
                    differ = pc.fill_null(pc.not_equal(one, two), False)
                    differ = pc.or_(differ, pc.xor(pc.is_null(one), pc.is_null(two)))
                    starts[1:] |= differ.to_numpy(zero_copy_only=False)
            starts[0] = key_at(batch, 0) != last
            last = key_at(batch, n - 1)
            where = np.arange(n)
            begun = np.maximum.accumulate(np.where(starts, where, -1))
            local = where - np.maximum(begun, 0) + 1 + np.where(begun < 0, rows, 0)
            out = [pa.array(local, pa.int64())]
            rows = int(local[-1])
            if weight:
                w = column(batch, weight).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(w)
                run = upto - np.where(begun < 0, 0, (upto - w)[np.maximum(begun, 0)]) + np.where(begun < 0, total, 0)
                out.append(pa.array(run, pa.int64()))
                total = int(run[-1])
            if since:
                col = column(batch, since)
                some = np.where(col.is_valid().to_numpy(zero_copy_only=False), where, n)
                found = np.minimum.accumulate(some[::-1])[::-1][np.maximum(begun, 0)]  # first value at or after the group's begin
                value = col.take(pa.array(found, pa.int64(), mask=found > where))
                if early is not None and early.is_valid:
                    value = pc.if_else(pa.array(begun < 0), early, value)
                out.append(value)
                early = value[n - 1]
            waiting = (batch, out, starts, edge)
        if waiting is not None:
            yield finished(*waiting, None)

    return step


def histories(df: DataFrame, group: list[str], order: list[str], rank: str, weight: str | None = None, run: str = "upto", since: str | None = None, begun: str = "begun", nexts: Sequence[str] = (), prefix: str = "next_") -> DataFrame:
    """`positions`, the group's first value of `since` that is not null up to each row, and `lead` of `nexts`, in one pass.

    One range shuffle, written once, whatever is asked for. Each task works out its own rows while it writes; only the
    group cut by a task border needs more: one row per task carries what earlier tasks hold of it and the next task's first row.
    `since` must not fall inside a group, as the leading column of `order` does not. Null groups are one group.
    """
    kept = df.columns
    laid = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    types = {f.name: f.dataType for f in laid.schema.fields}
    added = [T.StructField("_rank", T.LongType())] + [T.StructField("_run", T.LongType())] * bool(weight)
    added += [T.StructField("_since", types[since])] if since else []
    added += [T.StructField(f"_next_{c}", types[c]) for c in nexts] + [T.StructField("_edge", T.IntegerType())]
    laid = laid.mapInArrow(_local_history(group, weight, since, list(nexts)), T.StructType([*laid.schema.fields, *added]))
    laid = laid.drop(weight) if weight else laid
    laid = materialise(laid.withColumn("_part", F.spark_partition_id()), "ordered")
    kept = [c for c in kept if c != weight]
    key = F.struct(F.lit(0).alias("_k"), *group)
    sums = ["_rank"] + (["_run"] if weight else [])
    carried = [*sums, *(["_since"] if since else [])]
    at = F.col("_edge")
    one = lambda wanted, value: F.first(F.when(at.isin(wanted, 3), value), ignorenulls=True)
    ends = laid.filter(at > 0).groupBy("_part").agg(
        one(1, F.struct(key.alias("g"), *nexts)).alias("_head"), one(2, F.struct(key.alias("g"), *carried)).alias("_tail")
    )
    ends = materialise(ends.select("_part", "_head", F.col("_head.g").alias("_first"), F.col("_tail.g").alias("_last"), *[f"_tail.{c}" for c in carried]), "task-ends")
    # tasks that end in a group are all before the one that begins in it and goes on, so one value per group and one
    # running value over its tasks place every piece; no task meets another
    fold = lambda c: F.min(c) if c == "_since" else F.sum(c)
    earlier = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = ends.select("_part", "_first", "_last", *[fold(c).over(earlier).alias(f"_e{c}") for c in carried], F.lead("_head").over(Window.partitionBy(F.lit(0)).orderBy("_part")).alias("_succ"))
    totals = ends.groupBy(F.col("_last").alias("_g")).agg(*[fold(c).alias(f"_t{c}") for c in carried])
    whole = F.col("_first").eqNullSafe(F.col("_last"))
    borders = within.join(totals, F.col("_first").eqNullSafe(F.col("_g")), "left").select(
        F.col("_part").alias("_p"), "_first", "_succ", *[F.when(whole, F.col(f"_e{c}")).otherwise(F.col(f"_t{c}")).alias(f"_b{c}") for c in carried]
    )
    joined = laid.join(sized(borders), F.col("_part") == F.col("_p"))
    goes_on = key.eqNullSafe(F.col("_first"))
    outs = [(F.col(c) + F.when(goes_on, F.coalesce(f"_b{c}", F.lit(0))).otherwise(F.lit(0))).alias(o) for c, o in zip(sums, (rank, run))]
    if since:
        outs.append(F.when(goes_on, F.coalesce("_b_since", "_since")).otherwise(F.col("_since")).alias(begun))
    outs += [F.when(at < 2, F.col(f"_next_{c}")).when(key.eqNullSafe(F.col("_succ.g")), F.col(f"_succ.{c}")).alias(f"{prefix}{c}") for c in nexts]
    return joined.select(*kept, *outs)


def with_next(df: DataFrame, group: list[str], order: list, cols: list[str], prefix: str = "next_") -> DataFrame:
    """`lead(col)` inside each group, exact across task borders; null on a group's last row."""
    return histories(df, group, order, "_row", nexts=cols, prefix=prefix).drop("_row")


Tiles = dict[str, tuple[str, int]]  # output column -> (metric column, number of tiles)


STEPS = 128  # buckets of values for each factor e
PARTS = 4096  # parts of a bucket that holds an end


def _bucket(v: Column) -> Column:
    """A number that never falls as `v` rises, so that a count by it tells between which values a rank lies; NaN is the greatest."""
    place = F.signum(v) * F.log1p(F.abs(v)) * STEPS
    return F.when(F.isnan(v), 1 << 20).otherwise(F.floor(F.greatest(F.least(place, F.lit(float(1 << 20))), F.lit(-float(1 << 20))))).cast("int")


def _holding(counts: DataFrame, group: list[str], order: str, ends: Column | None = None) -> DataFrame:
    """Counted buckets that hold one of the ranks `_ends`, which then count from the bucket's first row."""
    w = Window.partitionBy(*group)
    before = F.sum("_n").over(w.orderBy(order)) - F.col("_n")
    placed = counts.withColumns({"_before": before, "size": F.sum("_n").over(w)})
    if ends is not None:
        placed = placed.withColumn("_ends", ends)
    inside = F.filter("_ends", lambda e: (e > F.col("_before")) & (e <= F.col("_before") + F.col("_n")))
    placed = placed.withColumn("_ends", F.transform(F.array_distinct(inside), lambda e: e - F.col("_before")))
    return placed.filter(F.size("_ends") > 0).drop("_before", "size", "_n")


def tile_cuts(df: DataFrame, group: list[str], tiles: Tiles, ident: str) -> DataFrame:
    """Per (group, tile column): the sorted array `cuts` of the last rows (v, id) of all tiles but one.

    Rows are counted by buckets of the metric, those of the buckets in which a tile ends again by equal parts of the bucket
    (of its idents, if it holds one value only). Only rows of parts in which a tile ends are put in order and numbered.
    """
    keys = [*group, "tile"]
    entries = [F.struct(F.lit(out).alias("tile"), F.lit(k).alias("k"), F.col(m).cast("double").alias("v")) for out, (m, k) in tiles.items()]
    long = df.select(*group, ident, F.explode(F.array(*entries)).alias("_m")).select(*group, "_m.tile", "_m.k", "_m.v", ident)
    long = long.filter(F.col("v").isNotNull()).withColumn("_b", _bucket(F.col("v")))
    numeric = isinstance(df.schema[ident].dataType, T.IntegralType)
    bounds = [F.min("v").alias("_lo"), F.max("v").alias("_hi")] + ([F.min(ident).alias("_from"), F.max(ident).alias("_to")] if numeric else [])
    counted = long.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("k").alias("k"), *bounds)
    base, extra = F.floor(F.col("size") / F.col("k")), F.col("size") % F.col("k")
    ends = F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda j: j * base + F.least(j, extra))
    chosen = sized(_holding(counted, keys, "_b", ends).drop("k"))
    near = _join_on(long.drop("k"), chosen, [*keys, "_b"])
    one = F.col("_lo") == F.col("_hi")
    by_ident = (F.col(ident).cast("double") - F.col("_from").cast("double")) / (F.col("_to").cast("double") - F.col("_from").cast("double") + 1) if numeric else F.lit(0.0)
    wide = F.col("_hi") - F.col("_lo")
    by_value = F.when(F.abs(wide) < float("inf"), (F.col("v") - F.col("_lo")) / F.when(one, 1.0).otherwise(wide)).otherwise(0.0)
    # a null ident is the first one
    near = near.withColumn("_s", F.coalesce(F.floor(F.when(one, by_ident).otherwise(by_value) * PARTS).cast("int"), F.lit(-1)))
    near = near.drop("_lo", "_hi", "_from", "_to")
    parts = near.groupBy(*keys, "_b", "_s").agg(F.count(F.lit(1)).alias("_n"), F.first("_ends").alias("_ends"))
    parts = sized(_holding(parts, [*keys, "_b"], "_s"))
    placed = positions(_join_on(near.drop("_ends"), parts, [*keys, "_b", "_s"]), [*keys, "_b", "_s"], ["v", ident])
    return (
        placed.filter(F.array_contains("_ends", F.col("rn")))
        .groupBy(*keys)
        # k-1 rows per group at most
        .agg(F.array_sort(F.collect_list(F.struct(F.col("v"), F.col(ident).alias("id")))).alias("cuts"))
    )


def _below(row: Column):
    return lambda cut: cut < row


def with_tiles(df: DataFrame, group: list[str], tiles: Tiles, ident: str) -> DataFrame:
    """Add `ntile(k)` columns, each ordered by (metric, ident) in its group; null metrics get null.

    The input is written once because it is read twice: for the cut rows and for the result. Only
    the cut rows travel back, so the frame itself is not shuffled for the scores.
    """
    df = materialise(df, "tiles")
    cuts = tile_cuts(df, group, tiles, ident)
    wide = cuts.groupBy(*group).agg(
        *[F.first(F.when(F.col("tile") == out, F.col("cuts")), ignorenulls=True).alias(f"_cut_{out}") for out in tiles]
    )
    scored = _join_on(df, sized(wide), group, "left")
    for out, (m, _) in tiles.items():
        here = F.struct(F.col(m).cast("double").alias("v"), F.col(ident).alias("id"))
        passed = F.coalesce(F.size(F.filter(F.col(f"_cut_{out}"), _below(here))), F.lit(0))
        passed = F.when(F.col(f"_cut_{out}").isNull(), F.lit(0)).otherwise(passed)
        scored = scored.withColumn(out, F.when(F.col(m).isNotNull(), F.lit(1) + passed).cast("int"))
    return scored.drop(*[f"_cut_{out}" for out in tiles])


def quantiles(df: DataFrame, group: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group (the `quantile_cont` rule), one column per entry.

    Equal values are counted first, so the ordered pass sees distinct values only.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    run = running_total(counted, group, [value], "_n", "_upto", "_size")
    aggs = []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("_size") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        holds = lambda rank: (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
        low = F.max(F.when(holds(lo), F.col(value)))
        high = F.max(F.when(holds(hi), F.col(value)))
        frac = F.max(pos - lo)
        aggs.append((low + (high - low) * frac).alias(name))
    return run.groupBy(*group).agg(*aggs)
