"""Merkle manifest of a dataset by checkpoint and recompute.

Leaves of one group ascend by their order; every 2 consecutive nodes, or a last single one, are hashed
into their parent until one node, the group's root, remains (a lone leaf is the root itself). Only every
`span`-th level is persisted, as rows (group, level, at, digest). Whatever lies between is recomputed from
the stored descendants of one aligned subtree, 2^span nodes at most, used, and thrown away:

* `build` raises subtree after subtree to the next stored level;
* `proofs` goes back down: a subtree regenerates its interior, hands the path so far plus its own siblings
  to each of its nodes, and the leaves' subtrees emit one proof for each leaf.

No task ever holds more than one subtree, however large a group is, and siblings travel once for each
subtree instead of once for each leaf.

The group is one column; its nulls are a group like any other. Rows with the same order and leaf are
interchangeable. An empty table has no nodes, no roots and no proofs. Leaves, however long the rows
behind them, are digests of 64 characters.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.ordering import positions
from martloom.session import materialise, sized

SPAN = 8  # levels between two stored ones: 256 nodes in a subtree


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def parent(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def interior(nodes: list[str], height: int) -> list[list[str]]:
    """The subtree's levels from `nodes` up, `height` of them above it."""
    levels = [list(nodes)]
    for _ in range(height):
        low = levels[-1]
        levels.append([parent(*low[i : i + 2]) for i in range(0, len(low), 2)])
    return levels


def height_of(total: int, span: int) -> int:
    """Levels a subtree rises in a group that has `total` nodes on its lowest level."""
    return min(span, max(0, total - 1).bit_length())


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """The sibling of node `at` on each level below the top; empty where the node is alone."""
    found = []
    for level in levels[:-1]:
        other = at ^ 1
        found.append(level[other] if other < len(level) else "")
        at >>= 1
    return found


def folded(leaf: str, at: int, path: list[str]) -> str:
    """The root above `leaf`: position `at` tells on which side each sibling stands."""
    for other in path:
        leaf = parent(leaf) if not other else parent(other, leaf) if at & 1 else parent(leaf, other)
        at >>= 1
    return leaf


@dataclass
class Manifest:
    leaves: DataFrame  # grp, at, digest and the rows' own columns
    stored: list[DataFrame]  # grp, at, digest, total for every span-th level, leaves first
    roots: DataFrame  # grp, total (leaves), digest
    span: int


def _subtrees(nodes: DataFrame, span: int, extra: list[str] = []) -> DataFrame:
    """One row for each aligned subtree, its nodes in order."""
    return nodes.groupBy("grp", "total", F.shiftright("at", span).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest", *extra))).alias("nodes")  # 2^span at most
    )


def _raised(span: int):
    def step(batches):
        import pyarrow as pa

        for batch in batches:
            tops = []
            for total, nodes in zip(batch.column("total").to_pylist(), batch.column("nodes").to_pylist()):
                tops.append(interior([n["digest"] for n in nodes], height_of(total, span))[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("block"), pa.array(tops, pa.string()), batch.column("total")], names=["grp", "at", "digest", "total"]
            )

    return step


def build(leaves: DataFrame, group: str, order: list, digest: str, span: int = SPAN) -> Manifest:
    """Number the leaves of each group and persist every `span`-th level above them."""
    placed = leaves.withColumnsRenamed({group: "grp", digest: "digest"})
    numbered = positions(placed, ["grp"], [*order, "digest"], "at").withColumn("at", F.col("at") - 1)
    totals = materialise(numbered.groupBy("grp").agg(F.count(F.lit(1)).alias("total")), "merkle-totals")
    named = totals.select(F.col("grp").alias("_g"), "total")
    numbered = materialise(numbered.join(named, F.col("grp").eqNullSafe(F.col("_g"))).drop("_g"), "merkle-leaves")
    level = numbered.select("grp", "at", "digest", "total")
    stored, finished = [level], []
    schema = level.schema
    largest = totals.agg(F.max("total")).first()[0] or 0
    while largest > 1:
        raised = _subtrees(level.filter("total > 1"), span).mapInArrow(_raised(span), schema)
        finished.append(level.filter("total = 1"))
        up = F.shiftright(F.col("total") + ((1 << span) - 1), span)
        level = materialise(raised.withColumn("total", up), "merkle-level")
        stored.append(level)
        largest = -(-largest >> span)
    finished.append(level.filter("total = 1"))
    tops = finished[0]
    for more in finished[1:]:
        tops = tops.unionByName(more)
    tops = materialise(tops.select(F.col("grp").alias("_g"), "digest"), "merkle-roots")
    roots = totals.join(tops, F.col("grp").eqNullSafe(F.col("_g"))).drop("_g")
    return Manifest(numbered, stored, roots, span)


def _handed_down(span: int):
    """Regenerate each subtree and hand every node its path: own siblings, then the subtree's."""

    def step(batches):
        import pyarrow as pa

        for batch in batches:
            grp, at, path, source = [], [], [], []
            rows = zip(*[batch.column(c).to_pylist() for c in ("block", "total", "nodes", "path")])
            for i, (block, total, nodes, above) in enumerate(rows):
                levels = interior([n["digest"] for n in nodes], height_of(total, span))
                for k, node in enumerate(nodes):
                    source.append(i)
                    at.append(node["at"])
                    path.append(siblings(levels, k) + above)
            grp = batch.column("grp").take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([grp, pa.array(at, pa.int64()), pa.array(path, pa.list_(pa.string()))], names=["_g", "_b", "path"])

    return step


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")


def subtree_paths(manifest: Manifest, above: DataFrame) -> DataFrame:
    """(_g, _b, path) for every subtree of leaves; `above` (_g, path) is what follows on a group's root."""
    span = manifest.span
    grp = manifest.leaves.schema["grp"].dataType
    schema = T.StructType([T.StructField("_g", grp), T.StructField("_b", T.LongType()), T.StructField("path", T.ArrayType(T.StringType()))])
    start = above.select("_g", F.lit(0).cast("long").alias("_b"), "path")
    paths = None
    for level in reversed(manifest.stored[1:]):
        # a group's top node takes the path above it; groups that end lower start there
        tops = level.filter("total = 1").select("grp").join(start, F.col("grp").eqNullSafe(F.col("_g"))).select("_g", "_b", "path")
        if paths is None:
            paths = tops
            continue
        inner = _with_paths(_subtrees(level.filter("total > 1"), span), paths).mapInArrow(_handed_down(span), schema)
        paths = materialise(inner.unionByName(tops), "merkle-paths")
    lone = manifest.stored[0].filter("total = 1").select("grp").join(start, F.col("grp").eqNullSafe(F.col("_g"))).select("_g", "_b", "path")
    return lone if paths is None else paths.unionByName(lone)


def _proofs(span: int, carried: list[str]):
    def step(batches):
        import pyarrow as pa

        for batch in batches:
            source, at, own, shas, folds = [], [], [], [], []
            rest: dict[str, list] = {c: [] for c in carried}
            for i, (total, nodes, above) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("total", "nodes", "path")])):
                levels = interior([n["digest"] for n in nodes], height_of(total, span))
                for k, node in enumerate(nodes):
                    path = siblings(levels, k) + above
                    source.append(i)
                    at.append(node["at"])
                    own.append(node["digest"])
                    for c in carried:
                        rest[c].append(node[c])
                    folds.append((node["at"], node["presented"], path))
                    shas.append(parent(*path))
            grp = batch.column("grp").take(pa.array(source, pa.int64()))
            where = batch.column("rank").take(pa.array(source, pa.int64())).to_pylist()
            heights = batch.column("height").take(pa.array(source, pa.int64())).to_pylist()
            roots = []
            for (k, leaf, path), rank, height in zip(folds, where, heights):
                roots.append(folded(folded(leaf, k, path[:height]), rank, path[height:]))
            kinds = batch.schema.field("nodes").type.value_type
            columns = [pa.array(rest[c], kinds.field(c).type) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [grp, pa.array(at, pa.int64()), pa.array(own, pa.string()), *columns, pa.array(shas, pa.string()), pa.array(roots, pa.string())],
                names=["grp", "at", "digest", *carried, "proof_sha256", "folded_root"],
            )

    return step


def proofs(leaves: DataFrame, group: str, order: list, digest: str, presented: str, carried: list[str], span: int = SPAN) -> DataFrame:
    """One proof for each leaf of a two-part tree: groups of leaves, then the groups' roots in ascending order.

    `presented` is the leaf digest a holder shows; it is folded with the siblings of the true leaf.
    Returns `group`, `carried`, leaf, subroot, root, proof_sha256 (over the siblings, bottom up) and
    folded_root.
    """
    # fixed names inside, so that no column of the input clashes
    inside = {c: f"_c{i}" for i, c in enumerate(carried)}
    plain = leaves.select(
        F.col(f"`{group}`").alias("grp"),
        F.col(f"`{digest}`").alias("digest"),
        F.col(f"`{presented}`").alias("presented"),
        *[F.col(f"`{c}`").alias(i) for c, i in inside.items()],
    )
    lower = build(plain, "grp", [inside.get(c, c) for c in order], "digest", span)
    subroots = lower.roots.select(F.lit(0).alias("top"), F.col("grp").alias("name"), "digest", F.col("total").alias("leaves"))
    upper = build(subroots, "top", ["name"], "digest", span)
    # the tree of groups: its leaves are subroots
    nothing = upper.roots.select(F.col("grp").alias("_g"), F.array().cast("array<string>").alias("path"))
    blocks = _with_paths(_subtrees(upper.stored[0], span), subtree_paths(upper, nothing))
    paths = blocks.mapInArrow(
        _handed_down(span), T.StructType([T.StructField("_g", T.IntegerType()), T.StructField("_b", T.LongType()), T.StructField("path", T.ArrayType(T.StringType()))])
    )
    named = upper.leaves.select("grp", "name", "at", "leaves", F.col("digest").alias("subroot"))
    height = F.when(F.col("leaves") > 1, F.length(F.bin(F.col("leaves") - 1))).otherwise(0)
    groups = materialise(
        named.join(paths.select("_b", "path"), F.col("at") == F.col("_b"))
        .join(upper.roots.select("grp", F.col("digest").alias("root")), "grp")
        .select(F.col("name").alias("_g"), "path", F.col("at").alias("rank"), height.alias("height"), "subroot", "root"),
        "merkle-groups",
    )
    below = subtree_paths(lower, groups.select("_g", "path"))
    full = _with_paths(_subtrees(lower.leaves, span, ["presented", *inside.values()]), below)
    full = full.join(groups.select(F.col("_g").alias("_n"), "rank", "height"), F.col("grp").eqNullSafe(F.col("_n"))).drop("_n", "block")
    kinds = lower.leaves.schema
    schema = T.StructType(
        [kinds["grp"], kinds["at"], kinds["digest"], *[kinds[i] for i in inside.values()], T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType())]
    )
    shown = full.mapInArrow(_proofs(span, list(inside.values())), schema)
    joined = shown.join(groups.select(F.col("_g").alias("_n"), "subroot", "root"), F.col("grp").eqNullSafe(F.col("_n")))
    own = [F.col(i).alias(c) for c, i in inside.items()]
    return joined.select(F.col("grp").alias(group), *own, F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root")
