"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation is well formed if its role initials read `(s?(ua)+)?`. A lattice node is (rows consumed,
initial reached). Its edges are the edits of one row (K keep, R new role, D delete) and I, the insertion of
an empty row. Two heaps search the lattice, forward from the beginning and backward from the end. Once no
unseen path can be cheaper or as cheap, all crossings of the least cost are completed, and the walk through
the marked nodes that takes the ASCII-least edit at every step spells the least audit.

Long conversations. Rows are numbered over tasks, and the lattice is cut into pieces of `PIECE` rows. The
costs between a piece's borders are summed from the end (one short row for each piece), the two heaps then run inside
each piece towards the border's remaining costs, for every initial it may be entered with, and the entries
are strung together. So no task holds more than one piece of the lattice; results don't depend on PIECE.
Only the digest of the repaired text passes a conversation through one task, as a sorted stream that
holds one hash state and the audit.

Null roles and texts count as one space; null turns come first and count for no gap. Rows with equal turn,
role and text are interchangeable; rows of one turn go by role, then text. A null conversation id is a
conversation like any other. Columns besides those named are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.ordering import positions
from martloom.session import materialise

PIECE = 4096  # rows of one conversation in one lattice
BLANKS = "\\x20\\x09-\\x0D"


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


# states: what the repaired rows so far end with; the mark row at the end of a conversation leads to DONE
START, SYSTEM, USER, ASSISTANT, DONE = range(5)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the row that may follow, but for a first system row
NAME = {USER: "user", ASSISTANT: "assistant"}
FAULTS = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
END = "$"  # the mark row

INFINITE = 1 << 60


def edges(rows: list[tuple[str, int]], at: int, state: int, costs: Costs) -> list[tuple[int, str, int, int]]:
    """(cost, edit, rows consumed, state) for every edit at a node; the end mark costs nothing and has no letter."""
    if at == len(rows) or state == DONE:
        return []
    initial, fault = rows[at]
    follows = NEXT[state]
    found = [(costs.insert, "I", at, follows)]
    if initial == END:
        if state in (START, ASSISTANT):
            found.append((0, "", at + 1, DONE))
        return found
    found.append((costs.delete, "D", at + 1, state))
    if fault not in (FAULTS["blank"], FAULTS["duplicate"]):
        extra = costs.truncated if fault == FAULTS["truncated"] else 0
        if KINDS.get(initial) == follows or (initial == "s" and state == START):
            found.append((extra, "K", at + 1, KINDS[initial]))
        found.append((extra + costs.rerole, "R", at + 1, follows))
    return found


def reversed_edges(rows: list[tuple[str, int]], at: int, state: int, costs: Costs) -> list[tuple[int, int, int]]:
    """(cost, rows consumed before, state before) for every edit that ends at a node."""
    found = []
    for before in range(ASSISTANT + 1):
        for where in (at, at - 1):
            if where >= 0:
                found += [(c, where, before) for c, _, to, s in edges(rows, where, before, costs) if to == at and s == state]
    return found


def least_edits(rows: list[tuple[str, int]], entry: int, exits: list[int], costs: Costs) -> tuple[int, str, int]:
    """(cost, audit, exit state) of the cheapest way from `entry` through all rows, then `exits[state]` beyond them."""
    last = len(rows)
    fore, back = {(0, entry): 0}, {(last, s): c for s, c in enumerate(exits) if c < INFINITE}
    ahead, behind = [(0, 0, entry)], sorted((c, last, s) for (_, s), c in back.items())
    settled, closed = set(), set()
    best = min((c for node, c in back.items() if node in fore), default=INFINITE)
    # paths as cheap as the best one have a node that both heaps settle, hence `<=`
    while ahead and behind and ahead[0][0] + behind[0][0] <= best:
        if ahead[0][0] <= behind[0][0]:
            cost, at, state = heapq.heappop(ahead)
            if (at, state) in settled:
                continue
            settled.add((at, state))
            for step, _, to, after in edges(rows, at, state, costs):
                if cost + step < fore.get((to, after), INFINITE):
                    fore[to, after] = cost + step
                    heapq.heappush(ahead, (cost + step, to, after))
                best = min(best, cost + step + back.get((to, after), INFINITE))
        else:
            cost, at, state = heapq.heappop(behind)
            if (at, state) in closed:
                continue
            closed.add((at, state))
            for step, of, before in reversed_edges(rows, at, state, costs):
                if cost + step < back.get((of, before), INFINITE):
                    back[of, before] = cost + step
                    heapq.heappush(behind, (cost + step, of, before))
                best = min(best, cost + step + fore.get((of, before), INFINITE))
    if best >= INFINITE:
        return INFINITE, "", entry

    # remaining cost of every node on a cheapest path: crossings first, then back along tight edges
    left = {}
    todo = [n for n, c in fore.items() if n in back and c + back[n] == best]
    for node in todo:
        left[node] = back[node]
    while todo:
        at, state = todo.pop()
        for step, of, before in reversed_edges(rows, at, state, costs):
            node = (of, before)
            if node not in left and fore.get(node, INFINITE) + step == fore.get((at, state), -1):
                left[node] = left[at, state] + step
                todo.append(node)
    audit, node = [], (0, entry)
    while node[0] < last:
        here = left[node] if node in left else back[node]
        for step, edit, to, after in sorted(edges(rows, *node, costs), key=lambda e: e[1]):
            rest = left.get((to, after), back.get((to, after), INFINITE))
            if step + rest == here:
                audit.append(edit)
                node = (to, after)
                break
        else:
            raise AssertionError("a cheapest path has a next edit")
    return best, "".join(audit), node[1]


def border_costs(rows: list[tuple[str, int]], costs: Costs) -> list[int]:
    """Cheapest cost from each entry state to each exit state of a piece, row by row."""
    found = []
    for entry in range(DONE):
        known, heap, done = {(0, entry): 0}, [(0, 0, entry)], set()
        while heap:
            cost, at, state = heapq.heappop(heap)
            if (at, state) in done:
                continue
            done.add((at, state))
            for step, _, to, after in edges(rows, at, state, costs):
                if cost + step < known.get((to, after), INFINITE):
                    known[to, after] = cost + step
                    heapq.heappush(heap, (cost + step, to, after))
        found += [known.get((len(rows), s), INFINITE) for s in range(DONE + 1)]
    return found


def decoded(codes: str) -> list[tuple[str, int]]:
    """Two characters for each row: initial and fault."""
    return [(codes[i], int(codes[i + 1])) for i in range(0, len(codes), 2)]


def per_row(audit: str, rows: list[tuple[str, int]], entry: int) -> list[tuple[int, str, str | None]]:
    """For each row: state before it, the edits up to and including its own, and its new role if it has one."""
    found, state, i = [], entry, 0
    for initial, _ in rows:
        begun, start = state, i
        while i < len(audit) and audit[i] == "I":
            state, i = NEXT[state], i + 1
        role = None
        if initial != END:
            edit = audit[i]
            i += 1
            if edit == "R":
                state = NEXT[state]
                role = NAME[state]
            elif edit == "K":
                state = KINDS[initial]
        found.append((begun, audit[start:i], role))
    return found


def _arrow(fields: str, work):
    """mapInArrow step that turns the rows of a batch, as dictionaries, into rows of `fields`."""

    def step(batches):
        import pyarrow as pa

        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
        names, types = zip(*[f.split(" ", 1) for f in fields.split(", ")])
        for batch in batches:
            out = [r for row in batch.to_pylist() for r in work(row)]
            columns = [pa.array([r[i] for r in out], kinds[t]) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return step


def _entries(pieces: DataFrame, costs: Costs) -> tuple[DataFrame, str]:
    """For every piece and every state it may be entered with: audit and exit state."""
    matrix = "g string, piece bigint, costs array<bigint>"
    beyond = "g string, piece bigint, exits array<bigint>"
    solved = "g string, piece bigint, entry bigint, audit string, leaves bigint"

    inner = pieces.filter("piece > 0").mapInArrow(_arrow(matrix, lambda r: [(r["g"], r["piece"], border_costs(decoded(r["codes"]), costs))]), matrix)
    # one row of 20 numbers for each piece of a long conversation
    chains = inner.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("piece", "costs"))).alias("chain"))
    width, finish = DONE + 1, [INFINITE] * DONE + [0]

    def summed(row):
        after, found = finish, []
        for link in reversed(row["chain"]):
            found.append((row["g"], link["piece"], after))
            m = link["costs"]
            after = [min(min(m[s * width + x] + after[x] for x in range(width)), INFINITE) for s in range(DONE)] + [INFINITE]
        found.append((row["g"], 0, after))
        return found

    borders = chains.mapInArrow(_arrow(beyond, summed), beyond).withColumnsRenamed({"g": "_g", "piece": "_p"})
    bounded = pieces.join(borders, (F.col("g") == F.col("_g")) & (F.col("piece") == F.col("_p")), "left").drop("_g", "_p")

    def searched(row):
        rows = decoded(row["codes"])
        for entry in range(DONE) if row["piece"] else (START,):
            cost, audit, leaves = least_edits(rows, entry, row["exits"] or finish, costs)
            if cost < INFINITE:
                yield row["g"], row["piece"], entry, audit, leaves

    return bounded.mapInArrow(_arrow(solved, searched), solved), solved


def row_edits(codes: DataFrame, costs: Costs = Costs(), piece: int = PIECE) -> DataFrame:
    """(_g, _pos, state, edits, new_role) for rows (g, pos, code) numbered from 0, the end mark included."""
    pieces = codes.groupBy("g", F.floor(F.col("pos") / piece).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda r: r["code"]), "").alias("codes")
    )
    pieces = materialise(pieces, "repair-pieces")
    solved, _ = _entries(pieces, costs)
    solved = materialise(solved, "repair-audits")
    # which entry each later piece really has: follow the exits
    links = solved.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("piece", "entry", "leaves"))).alias("chain"), F.max("piece").alias("top"))
    chosen = "g string, piece bigint, entry bigint"

    def followed(row):
        at = {(c["piece"], c["entry"]): c["leaves"] for c in row["chain"]}
        state = START
        for k in range(row["top"] + 1):
            if k:
                yield row["g"], k, state
            state = at[k, state]

    taken = links.filter("top > 0").mapInArrow(_arrow(chosen, followed), chosen).withColumnsRenamed({"g": "_g", "piece": "_p", "entry": "_e"})
    real = solved.join(taken, (F.col("g") == F.col("_g")) & (F.col("piece") == F.col("_p")), "left").filter(F.col("entry") == F.coalesce("_e", F.lit(START)))
    whole = real.select("g", "piece", "entry", "audit").join(pieces, ["g", "piece"])
    edits = "_g string, _pos bigint, state bigint, edits string, new_role string"

    def dealt(row):
        rows = decoded(row["codes"])
        for i, (state, letters, role) in enumerate(per_row(row["audit"], rows, row["entry"])):
            yield row["g"], row["piece"] * piece + i, state, letters, role

    return whole.mapInArrow(_arrow(edits, dealt), edits)


def faults(rows: DataFrame, role: str, text: str) -> DataFrame:
    """`rows` (g, pos, role, text) with the first fault of each; a duplicate repeats an earlier row's role and text."""
    said = rows.withColumn("_h", F.sha2(text, 256))
    first = said.groupBy("g", role, "_h").agg(F.min("pos").alias("_first"))
    first = first.select(F.col("g").alias("_g"), F.col(role).alias("_r"), F.col("_h").alias("_k"), "_first")
    joined = said.join(first, (F.col("g") == F.col("_g")) & (F.col(role) == F.col("_r")) & (F.col("_h") == F.col("_k")))
    seen = F.regexp_extract(F.col(text), f"([^{BLANKS}])[{BLANKS}]*\\z", 1)
    fault = (
        F.when(seen == "", "blank").when(F.col("pos") > F.col("_first"), "duplicate").when(~seen.isin(".", "!", "?"), "truncated").otherwise("")
    )
    return joined.withColumn("fault", fault).drop("_h", "_g", "_r", "_k", "_first")


def _reports(costs: Costs):
    """One row for each conversation of a stream sorted by (g, pos)."""

    def step(batches):
        import hashlib

        import pyarrow as pa

        def fresh(row):
            return {
                "g": row["g"], "conv": row["conv"], "turns": 0, "low": None, "high": None, "blank": 0, "duplicate": 0, "truncated": 0,
                "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "begun": False, "last": None, "turn": None,
            }

        def told(now, role, text):
            now["sha"].update((("\n" if now["begun"] else "") + role + ":" + text).encode())
            now["begun"] = True

        def take(now, row):
            state = row["state"]
            for edit in row["edits"]:
                if edit == "I":
                    state = NEXT[state]
                    now["cost"] += costs.insert
                    told(now, NAME[state], "")
                elif edit == "D":
                    now["cost"] += costs.delete
                else:
                    now["cost"] += (costs.rerole if edit == "R" else 0) + (costs.truncated if row["fault"] == "truncated" else 0)
                    told(now, row["new_role"] or row["role"], row["text"])
            now["audit"].append(row["edits"])
            if row["end"]:
                return
            if row["turn"] is not None:
                now["turns"] += row["turn"] != now["turn"]
                now["turn"] = row["turn"]
                now["low"] = row["turn"] if now["low"] is None else now["low"]
                now["high"] = row["turn"]
            if row["fault"]:
                now[row["fault"]] += 1
            initial = row["role"][:1]
            if now["last"] is not None and now["last"] + initial not in ("su", "ua", "au"):
                now["illegal"] += 1
            now["last"] = initial

        def batch_of(done):
            columns = [[d["conv"] for d in done], [0 if d["low"] is None else d["high"] - d["low"] + 1 - d["turns"] for d in done]]
            columns += [[d[c] for d in done] for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            arrays += [pa.array(["".join(d["audit"]) for d in done], pa.string()), pa.array([d["sha"].hexdigest() for d in done], pa.string())]
            names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        now = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or row["g"] != now["g"]:
                    if now is not None:
                        done.append(now)
                    now = fresh(row)
                take(now, row)
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([now])

    return step


REPORT = "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", named: DataFrame | None = None, costs: Costs = Costs(), piece: int = PIECE) -> DataFrame:
    """One report for each conversation of `rows`, and for those that only `named` (a frame with `conv`) holds."""
    space = F.lit(" ")
    plain = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.lit(False).alias("end"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`"), space).alias("text"),
    )
    ids = (rows if named is None else named).select(F.col(f"`{conv}`").cast("long").alias("conv")).distinct()
    nothing = F.lit(None).cast("long").alias("turn")
    marks = ids.select("conv", F.lit(True).alias("end"), nothing, F.lit("").alias("role"), F.lit("").alias("text"))
    key = F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("g")  # no number is written as nothing
    both = plain.unionByName(marks).select(key, "conv", "end", "turn", "role", "text")
    numbered = positions(both, ["g"], ["end", "turn", "role", "text"], "pos").withColumn("pos", F.col("pos") - 1)
    numbered = materialise(numbered, "repair-rows")
    judged = faults(numbered.filter(~F.col("end")), "role", "text").unionByName(numbered.filter("end").withColumn("fault", F.lit("")))
    judged = materialise(judged, "repair-faults")
    known = F.create_map(*[F.lit(x) for pair in FAULTS.items() for x in pair])
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("end"), END).when(initial.isin(*KINDS), initial).otherwise("x")
    codes = judged.select("g", "pos", F.concat(kind, known[F.col("fault")].cast("string")).alias("code"))
    edits = row_edits(codes, costs, piece)
    stream = judged.join(edits, (F.col("g") == F.col("_g")) & (F.col("pos") == F.col("_pos"))).drop("_g", "_pos")
    return stream.repartition("g").sortWithinPartitions("g", "pos").mapInArrow(_reports(costs), REPORT).withColumnRenamed("conv", conv)
