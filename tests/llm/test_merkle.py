"""Merkle proofs against a tree built whole in memory."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from martloom.llm.merkle import build, leaf_of, proofs


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        found.append((level[at ^ 1] if at ^ 1 < len(level) else "", at & 1))
        at >>= 1
    return found


def plain(rows):
    """rows (id, group, leaf, shown) -> sorted (id, leaf, subroot, root, proof, folded)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = {g: tree([r[2] for r in groups[g]]) for g in names}
    upper = tree([lower[g][-1][0] for g in names])
    out = []
    for rank, g in enumerate(names):
        for at, (ident, _, leaf, shown) in enumerate(groups[g]):
            steps = path(lower[g], at) + path(upper, rank)
            node = shown
            for other, right in steps:
                node = h(other + node if right else node + other)
            out.append((ident, leaf, lower[g][-1][0], upper[-1][0], h("".join(s for s, _ in steps)), node))
    return sorted(out, key=repr)


def case(n, groups):
    rows = []
    for i in range(n):
        leaf = h(str(i))
        rows.append((i, groups[i * i % len(groups)], leaf, leaf if i % 7 else h("x" + leaf)))
    return rows


CASES = {
    "empty": [],
    "one": case(1, ["en"]),
    "two groups": case(2, ["en", None]),
    "lone leaves": case(5, ["a", "b", "c", None, "é"]) + [(9, "z", h("q"), h("q"))],
    "powers": case(64, ["en"]),
    "odd": case(77, ["en", "en", "en", "de", None]),
    "nulls and repeated rows": [(None, "en", h("n"), h("n"))] * 2 + [(3, "en", h("a"), h("a"))] * 3 + [(3, "en", h("0"), h("1"))],
}


@pytest.mark.parametrize("name, span", [*[(name, 8) for name in CASES], ("odd", 1), ("lone leaves", 1), ("odd", 2), ("powers", 3)])
def test_proofs_equal_a_tree_in_memory(spark, name, span):
    rows = CASES[name]
    # column names that the operator uses itself
    leaves = spark.createDataFrame(rows, "path long, grp string, digest string, presented string")
    found = proofs(leaves, "grp", ["path"], "digest", "presented", ["path"], span).collect()
    got = sorted(((r["path"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in found), key=repr)
    assert got == plain(rows)


def test_only_every_few_levels_are_stored(spark):
    rows = case(200, ["en"])
    made = build(spark.createDataFrame(rows, "id long, lang string, leaf string, shown string"), "lang", ["id"], "leaf", 3)
    whole = tree([r[2] for r in rows])
    assert [s.count() for s in made.stored] == [len(whole[k]) for k in (0, 3, 6, 8)]
    assert made.roots.first()["digest"] == whole[-1][0]


def test_leaf_fields(spark):
    row = spark.createDataFrame([(5, None, "é", None)], "a long, b string, c string, d long").select(leaf_of(*map(F.col, "abcd"))).first()
    assert row[0] == h("1:5" + "-" + "2:é" + "-")
