"""Conversations as training windows of a token budget.

Running sums of turn tokens place every turn in a window without walking through the conversation:
with `room` the budget left beside the system turn and the history, a turn belongs to the cell of
width room/2 in which it starts, and a turn longer than that ends its cell in a window of its own. So
windows are runs of whole turns, hold at most `room` new tokens unless one single turn is longer, and
nothing is cut. Every window starts with the conversation's leading system turn and repeats the last
turns before it, as many as fit the history budget. Only the first appearance of an assistant text
is under the loss mask; repeated targets are masked out.

Template: `<|role|>\\n` text `<|end|>\\n`. In texts a backslash becomes two and `<|` becomes `<\\p`, in
roles every bar does, so no text can hold a marker and every text comes back unchanged. Null texts
and roles count as empty; a null conv_id is a conversation of its own; turns are ordered by turn
(null first), then role, then text hash; rows equal in all of them are repeated as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.ordering import positions
from martloom.session import materialise, sized

MARKS = 4  # tokens counted for the markers of a turn
END = "<|end|>\n"
WORD = "[^\\x20\\x09-\\x0D]+"


def token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long") + F.lit(MARKS)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\p"))


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "|" if m[1] == "p" else m[1], text, flags=re.S)


_TURN = re.compile(r"<\|([^|]*)\|>\n(.*?)<\|end\|>\n", re.S)


def parsed(window: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    return [(unescaped(role), unescaped(text)) for role, text in _TURN.findall(window)]


def windows(turns: DataFrame, budget: int = 512, history_turns: int = 2, history_budget: int = 96) -> DataFrame:
    """(conv_id, window, formatted, loss, repeated, tokens) from conv_id, turn, role, text.

    `loss` lists code-point spans of `formatted`; `repeated` leading turns were shown before.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    clean = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    clean = clean.withColumn("tokens", token_count(F.col("text"))).withColumn("_h", F.xxhash64("text"))
    placed = positions(clean, ["conv_id"], ["turn", "role", "_h"], "rn", "tokens", "upto").drop("_h", "turn")
    leads = (F.col("rn") == 1) & (F.col("role") == "system")
    system = sized(
        placed.filter(leads).select(F.col("conv_id").alias("_c"), F.col("role").alias("_role"), F.col("text").alias("_text"), F.col("tokens").alias("_tokens"))
    )
    mine = F.col("conv_id").eqNullSafe(F.col("_c"))
    others = placed.filter(~leads).join(system.select("_c", "_tokens"), mine, "left").drop("_c")
    taken = F.coalesce("_tokens", F.lit(0))
    half = F.greatest(F.lit(1), F.floor((F.lit(budget - history_budget) - taken) / 2)).cast("long")
    begin = F.col("upto") - F.col("tokens") - taken
    cell = F.floor(begin / half).cast("long")
    own = others.withColumn("window", 2 * cell + F.when(F.col("tokens") > half, 1).otherwise(0))
    own = materialise(own.select("conv_id", "window", "rn", "role", "text", "tokens"), "turn-windows")
    heads = materialise(own.groupBy("conv_id", "window").agg(F.min("rn").alias("_first")), "window-heads")

    back = heads.select(F.col("conv_id").alias("_c"), F.col("window").alias("_w"), F.explode(F.sequence(F.lit(1), F.lit(history_turns))).alias("_back"), "_first")
    back = back.withColumn("_rn", F.col("_first") - F.col("_back")).filter("_rn > 0")
    again = own.drop("window").join(back, mine & (F.col("rn") == F.col("_rn")))
    again = again.select("conv_id", F.col("_w").alias("window"), "rn", "role", "text", "tokens", F.lit(1).alias("kind"))

    shown = heads.join(system, mine).select(
        "conv_id", "window", F.lit(1).cast("long").alias("rn"), F.col("_role").alias("role"), F.col("_text").alias("text"), F.col("_tokens").alias("tokens"),
        F.when(F.col("_first") == 2, 0).otherwise(2).alias("kind"),
    )
    alone = system.join(heads.select("conv_id"), mine, "left_anti").select(
        F.col("_c").alias("conv_id"), F.lit(0).cast("long").alias("window"), F.lit(1).cast("long").alias("rn"), F.col("_role").alias("role"),
        F.col("_text").alias("text"), F.col("_tokens").alias("tokens"), F.lit(0).alias("kind"),
    )
    every = own.withColumn("kind", F.lit(0)).unionByName(again).unionByName(shown).unionByName(alone)
    # a window's turns: bounded by the budget, or one long turn
    grouped = every.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("rn", "kind", "role", "text", "tokens"))).alias("_all"))

    def fits(t):
        later = F.filter("_all", lambda u: (u["kind"] == 1) & (u["rn"] >= t["rn"]))
        total = F.aggregate(later, F.lit(0).cast("long"), lambda acc, u: acc + u["tokens"])
        return (t["kind"] != 1) | (total <= history_budget)

    def shape(t):
        head = F.concat(F.lit("<|"), escaped_role(t["role"]), F.lit("|>\n"))
        target = (t["kind"] == 0) & (t["role"] == "assistant")
        return F.struct(head.alias("head"), escaped(t["text"]).alias("body"), target.alias("target"), t["tokens"].alias("tokens"), t["kind"].alias("kind"))

    shaped = grouped.withColumn("_t", F.transform(F.filter("_all", fits), shape))
    length = lambda x: F.length(x).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def walk(acc, t):
        begun = acc["at"] + length(t["head"])
        ended = begun + length(t["body"])
        spans = F.when(t["target"], F.concat(acc["spans"], F.array(F.struct(begun.alias("start"), ended.alias("end"))))).otherwise(acc["spans"])
        return F.struct((ended + len(END)).alias("at"), spans.alias("spans"))

    return shaped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("_t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("_t", start, walk, lambda acc: acc["spans"]).alias("loss"),
        F.size(F.filter("_t", lambda t: t["kind"] != 0)).alias("repeated"),
        F.aggregate("_t", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"]).alias("tokens"),
    )


def _read(batches: Iterator):
    """Digests of each conversation from its windows in order; keeps one hash state, never the texts."""
    import hashlib

    import pyarrow as pa

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state, out = None, []

    def closed():
        return (state["id"], state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

    for batch in batches:
        kinds[0] = batch.schema.field(0).type
        for conv, formatted, loss, repeated in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if state is None or state["id"] != conv:
                if state is not None:
                    out.append(closed())
                state = {"id": conv, "turns": 0, "all": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
            state["chars"] += len(formatted)
            for role, text in parsed(formatted)[repeated:]:
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescaped(formatted[span["start"] : span["end"]])
                state["loss_chars"] += len(text)
                state["loss"].update(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(closed(), kinds)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted windows alone.

    A digest runs over a conversation in order, so its windows pass through one task as a sorted
    stream; the task holds one window and two hash states, however long the conversation is.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.select("conv_id", "formatted", "loss", "repeated").mapInArrow(_read, schema)
