"""Conversation repair against a plain dynamic program over all edits."""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import pytest

from martloom.llm.queries.op13_repair import damaged
from martloom.llm.repair import ASSISTANT, DONE, END, INFINITE, START, Costs, least_edits, repaired


def plain_edits(rows):
    """(cost, audit, repaired) by comparing whole audits; rows (role, text, fault)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserts=0):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            c, a, t = best(i, after[state], inserts + 1)
            found.append((c + 3, "I" + a, (name[after[state]] + ":",) + t))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, t = best(i + 1, state)
            found.append((c + 4, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] == after[state] or (role[:1] == "s" and not state):
                    c, a, t = best(i + 1, role[:1])
                    found.append((c + more, "K" + a, (role + ":" + text,) + t))
                c, a, t = best(i + 1, after[state])
                found.append((c + more + 3, "R" + a, (name[after[state]] + ":" + text,) + t))
        return min(found) if found else (10**9, "", ())

    return best(0, "")


def plain(rows):
    """rows (turn, role, text) of one conversation."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        left = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
        if fault:
            counts[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, lines = plain_edits(tuple(judged))
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_rows(rng):
    texts = ["a.", "b?", "c", " ", "", "d! ", "é…", None]
    return [(rng.choice([None, 1, 2, 3, 5, 9]), rng.choice(["user", "assistant", "system", "tool", "", "u", None]), rng.choice(texts)) for _ in range(rng.randint(0, 9))]


def told(found):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found.collect()}


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_random_conversations(spark, piece):
    rng = random.Random(5)
    talks = {i: random_rows(rng) for i in range(60)}
    talks[None] = [(1, "user", "hm."), (2, "user", "hm.")]
    rows = [(c, t, r, x, "extra") for c, said in talks.items() for t, r, x in said]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, g string")
    names = spark.createDataFrame([(c,) for c in talks], "conv_id long")
    assert told(repaired(frame, named=names, piece=piece)) == {c: plain(said) for c, said in talks.items()}


def test_heaps_agree_with_plain_program():
    rng = random.Random(9)
    faults = ["", "blank", "duplicate", "truncated"]
    for _ in range(400):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), "x", rng.choice(faults)) for _ in range(rng.randint(0, 9))]
        codes = [(r[:1] if r[:1] in "sua" else "x", faults.index(f)) for r, _, f in rows] + [(END, 0)]
        cost, audit, leaves = least_edits(codes, START, [INFINITE] * DONE + [0], Costs())
        assert (cost, audit) == plain_edits(tuple(rows))[:2] and leaves == DONE


def test_no_way_from_a_state_is_infinite():
    assert least_edits([("u", 0)], ASSISTANT, [INFINITE] * (DONE + 1), Costs())[0] == INFINITE


def test_long_conversation_in_pieces(spark):
    rng = random.Random(1)
    said = [(i, rng.choice(["user", "assistant"]), f"{rng.randint(0, 400)}" + rng.choice([".", "?", ""])) for i in range(900)]
    frame = spark.createDataFrame([(1, *r) for r in said], "conv_id long, turn long, role string, text string")
    assert told(repaired(frame, piece=64)) == told(repaired(frame))


def test_empty_table_and_damage(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repaired(empty).count() == 0
    rows = [(c, t, "assistant", "Yes. No!") for c in range(20) for t in range(10)]
    got = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    import zlib

    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "Yes No" if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, got)) == sorted(want)
