"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A model file of merge type is read as it is; nothing is trained. Text is cut into units at which no
piece of the vocabulary can reach across (before a space that follows another character). In each
unit an agenda of candidate merges is worked off from the best score, leftmost first. A candidate is
skipped for good with probability `dropout`, decided by a keyed hash of seed, document key, place of
the unit, unit and the candidate's bounds, so every occurrence draws anew, and the same key gives the
same segmentation on any machine. `streams` limits the draws to so many for each unit.

With dropout 0 the ids equal the library's. A literal U+2581 is written in byte pieces, as otherwise it
would come back as a space. Null texts give null ids; an empty text has none.

A task remembers for each unit the agenda without skips and the candidates it offers; an occurrence that
skips none of them has its ids. All others are worked off together as array operations, one merge for
each at a time. Very long texts are segmented in chunks, very long units with a heap.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
KEPT = 600_000  # units a task remembers; the memory changes speed only
KEPT_IDS = 8_000_000  # and their ids
LONGEST_KEPT = 64  # longer units are not remembered, and are worked off with a heap
WIDTHS = (6, 8, 10, 12, 16, 24, 32, 64)  # units up to the same width are worked off together
CHUNK = 1 << 20  # characters segmented together
WORD = (1 << 64) - 1
SCORELESS = np.iinfo(np.int32).max


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(self.size)]
        self.texts = [model.id_to_piece(i) for i in range(self.size)]
        self.ids = {p: i for i, p in enumerate(self.texts) if not special[i]}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.unknown = model.unk_id()
        if self.unknown in self.bytes:
            raise ValueError("the model must have byte pieces")
        # rank: best score first; equal scores are one rank
        scores = np.array([model.get_score(i) for i in range(self.size)])
        order = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.rank = order.tolist()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("pieces that reach across a space are not supported")
        # no merge reaches across a line break that no piece contains
        line = "" if any("\n" in p for p in self.ids) else "\n"
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + ("|\n" if line else ""))
        # id of each single character, -2 for characters that are written in bytes
        self.char_id = np.full(0x110000, -2, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        pairs, merged, ranks = [], [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs.append(a * self.size + b)
                    merged.append(i)
                    ranks.append(order[i])
        self._table(np.array(pairs, dtype=np.int64), np.array(merged, dtype=np.int64), np.array(ranks, dtype=np.int64))
        self.decoded = [p.replace(SPACE, " ") for p in self.texts]
        for b in range(128):
            self.decoded[self.bytes[b]] = chr(b)
        self.high = {i: b for i, b in self.byte_of.items() if b >= 128}

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; byte pieces are joined before they are read as UTF-8."""
        if self.high.keys().isdisjoint(ids):
            return "".join(map(self.decoded.__getitem__, ids))[1:]
        out, pending = [], bytearray()
        for i in ids:
            b = self.high.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode(errors="replace"))
                pending = bytearray()
            out.append(self.decoded[i])
        if pending:
            out.append(pending.decode(errors="replace"))
        return "".join(out)[1:]

    def _table(self, keys, merged, ranks) -> None:
        """Open-addressed lookup from a pair of ids to the merged id and its rank."""
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        mask = (1 << self.bits) - 1
        self.slot_key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.slot_id = np.zeros(1 << self.bits, dtype=np.int64)
        self.slot_rank = np.full(1 << self.bits, SCORELESS, dtype=np.int64)
        left, step, self.probes = np.arange(len(keys)), 0, 0
        while len(left):
            slots = (self._home(keys[left]) + step) & mask
            free = self.slot_key[slots] < 0
            first = np.zeros(len(left), dtype=bool)
            first[np.unique(slots, return_index=True)[1]] = True
            take = free & first
            at, who = slots[take], left[take]
            self.slot_key[at], self.slot_id[at], self.slot_rank[at] = keys[who], merged[who], ranks[who]
            left, step = left[~take], step + 1
            self.probes = step

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the pairs (of ids that are none below 0) that have a piece, with its id and rank."""
        keys = a.astype(np.int64) * self.size + b
        mask = (1 << self.bits) - 1
        slots = self._home(keys)
        here = self.slot_key[slots]
        hit = here == keys
        open_ = np.nonzero(~hit & (here >= 0))[0]
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slots[open_] = at = (slots[open_] + 1) & mask
            here = self.slot_key[at]
            hit[open_] = same = here == keys[open_]
            open_ = open_[~same & (here >= 0)]
        found = np.nonzero(hit)[0]
        slots = slots[found]
        return found, self.slot_id[slots], self.slot_rank[slots]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_text(text: str | bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text)


def _hash_units(units: list[str | None]) -> list[int]:
    from xxhash import xxh64_intdigest

    return [0 if unit is None else xxh64_intdigest(unit.encode("utf-8", "surrogatepass")) for unit in units]


def _hash_unit(unit: str) -> int:
    return _hash_units([unit])[0]


def _mix_one(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WORD
    return x ^ (x >> 31)


class _Pool:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.rows, self.n = np.empty(1 << 12, dtype=dtype), 0

    def extend(self, values) -> None:
        end = self.n + len(values)
        if end > len(self.rows):
            grown = np.empty(max(end, 2 * len(self.rows)), dtype=self.rows.dtype)
            grown[: self.n] = self.rows[: self.n]
            self.rows = grown
        self.rows[self.n : end] = values
        self.n = end


class _Numbers(dict):
    """Numbers for keys; new keys are listed in `fresh` and numbered from `base` on."""

    def __init__(self):
        self.base, self.fresh = 0, []

    def __missing__(self, key):
        n = self[key] = self.base + len(self.fresh)
        self.fresh.append(key)
        return n


class _Agendas:
    """Units met so far: hash, length, ids without skips, and the (mixed) bounds of all candidates offered on the way."""

    def __init__(self):
        self.numbers = _Numbers()
        self.hashes, self.length = _Pool(np.uint64), _Pool(np.int64)
        self.ids, self.id_first, self.id_n = _Pool(np.int32), _Pool(np.int64), _Pool(np.int64)
        self.mixed, self.offer_first, self.offer_n = _Pool(np.uint64), _Pool(np.int64), _Pool(np.int64)

    def add(self, units: list[str | None]) -> None:
        """Units in order, still without ids or offers; None is a literal mark."""
        self.hashes.extend(_hash_units(units))
        self.length.extend([0 if unit is None else len(unit) for unit in units])
        for pool in (self.id_first, self.id_n, self.offer_first, self.offer_n):
            pool.extend(np.zeros(len(units), dtype=np.int64))


def _place(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)


class Encoder:
    def __init__(self, pieces: Pieces, dropout: float = 0.0, seed: int = 0, streams: int | None = None):
        self.pieces, self.dropout, self.seed, self.streams = pieces, dropout, seed, streams
        self.limit = min(int(dropout * 2**64), WORD)
        self.mark = tuple(pieces.bytes[b] for b in SPACE.encode())
        self.known = _Agendas()

    def keys(self, draws: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Keyed hash of each occurrence from its draw and the hash of its unit."""
        return _mix(_mix(draws + np.uint64((self.seed * 0x9E3779B97F4A7C15) & WORD)) ^ hashes)

    def unit_key(self, unit: str, draw: int) -> int:
        return int(self.keys(np.array([draw], dtype=np.uint64), np.array([_hash_unit(unit)], dtype=np.uint64))[0])

    def skipped(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the candidate merge of [start, middle) and [middle, end) in a unit, by its key, is dropped."""
        if not self.dropout:
            return np.zeros(len(key), dtype=bool)
        return _mix(key ^ _mix(_place(start, middle, end))) < np.uint64(self.limit)

    def skipped_one(self, key: int, start: int, middle: int, end: int) -> bool:
        return bool(self.dropout) and _mix_one(key ^ _mix_one(((start << 42) ^ (middle << 21) ^ end) & WORD)) < self.limit

    def segment(self, todo: list[tuple[str, int]]) -> Iterator[tuple[str, int, tuple[int, ...]]]:
        """Piece ids of each (unit, draw), units of similar length together."""
        short = []
        for unit, draw in todo:
            if len(unit) > LONGEST_KEPT:
                yield unit, draw, self._heap(unit, draw)
            else:
                short.append((unit, draw))
        for part, width in _by_width(np.array([len(u) for u, _ in short], dtype=np.int64)):
            part = part.tolist()
            units, draws = [short[i][0] for i in part], np.array([short[i][1] for i in part], dtype=np.uint64)
            key = self.keys(draws, np.array(_hash_units(units), dtype=np.uint64))
            flat, n = self._agendas(units, width, lambda rows, start, middle, end: self.skipped(key[rows], start, middle, end))
            for i, ids in zip(part, np.split(flat, np.cumsum(n)[:-1])):
                yield *short[i], tuple(ids.tolist())

    def _learn(self, units: list[str | None]) -> None:
        """Remember units, in order; very long ones get no ids and no offers."""
        known, base = self.known, self.known.hashes.n
        known.add(units)
        if None in units:
            at = base + units.index(None)
            known.id_first.rows[at], known.id_n.rows[at] = known.ids.n, len(self.mark)
            known.ids.extend(self.mark)
        for part, width in _by_width(known.length.rows[base : known.length.n]):
            offered: list[tuple] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]

            def note(rows, start, middle, end):
                offered.append((rows, _mix(_place(start, middle, end))))
                return np.zeros(len(rows), dtype=bool)

            ids, n = self._agendas([units[i] for i in part.tolist()], width, note)
            rows, mixed = (np.concatenate(c) for c in zip(*offered))
            offers, at = np.bincount(rows, minlength=len(part)), base + part
            known.id_first.rows[at], known.id_n.rows[at] = known.ids.n + np.cumsum(n) - n, n
            known.offer_first.rows[at], known.offer_n.rows[at] = known.mixed.n + np.cumsum(offers) - offers, offers
            known.ids.extend(ids)
            known.mixed.extend(mixed[np.argsort(rows, kind="stable")])

    def _finished(self, row: list[int], unit: str) -> tuple[int, ...]:
        """Ids of one unit; a character without a piece is written in bytes."""
        found: list[int] = []
        for i, c in zip(row, unit):
            if i >= 0:
                found.append(i)
            elif i == -2:
                found.extend(self.pieces.bytes[b] for b in c.encode())
        return tuple(found)

    def _heap(self, unit: str, stream: int) -> tuple[int, ...]:
        pieces, key = self.pieces, self.unit_key(unit, stream)
        get, texts = pieces.ids.get, pieces.texts
        ids = [get(c, -2) for c in unit]
        n = len(ids)
        after, before, agenda = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(at):
            second = after[at] if at >= 0 else n
            if second >= n or ids[at] < 0 or ids[second] < 0:
                return
            merged = get(texts[ids[at]] + texts[ids[second]])
            if merged is not None and not self.skipped_one(key, at, second, after[second]):
                heapq.heappush(agenda, (pieces.rank[merged], at, second, after[second], merged))

        for at in range(n - 1):
            offer(at)
        while agenda:
            _, at, second, third, merged = heapq.heappop(agenda)
            if ids[at] < 0 or after[at] != second or after[second] != third or ids[second] < 0:
                continue  # one side has been merged since
            ids[at], ids[second], after[at] = merged, -3, third
            if third < n:
                before[third] = at
            offer(at)
            offer(before[at])
        return self._finished(ids, unit)

    def _agendas(self, units: list[str], width: int, skipped) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all units, and how many each has; `skipped` tells from rows and bounds which candidates are dropped."""
        n, row = len(units), width + 1
        length = np.fromiter(map(len, units), dtype=np.int64, count=n)
        inside = np.arange(row) < length[:, None]
        points = np.zeros((n, row), dtype=np.uint32)
        points[inside] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids = np.where(inside, self.pieces.char_id[points], np.int32(-1))
        odd = (ids == -2).any(1)
        # places count through all rows; the one after a unit holds -1, as does the one before the next unit
        here = ids.reshape(-1)
        after, before = np.arange(1, n * row + 1), np.arange(-1, n * row - 1)
        ranks = np.full((n, row), SCORELESS, dtype=np.int32)
        rank = ranks.reshape(-1)
        target = np.zeros(n * row, dtype=np.int32)

        def offer(at):
            second = after[at]
            piece = here[second]
            ok = np.nonzero(piece >= 0)[0]
            at, second = at[ok], second[ok]
            found, merged, score = self.pieces.look(here[at], piece[ok])
            at, second = at[found], second[found]
            rows = at // row
            first = rows * row
            kept = ~skipped(rows, at - first, second - first, after[second] - first)
            at = at[kept]
            rank[at] = score[kept]
            target[at] = merged[kept]

        offer(np.nonzero(here >= 0)[0])
        rows = np.arange(n)
        while True:
            best = ranks[rows].argmin(1) + rows * row
            some = rank[best] < SCORELESS
            rows, best = rows[some], best[some]
            if not len(rows):
                break
            second = after[best]
            third = after[second]
            here[best] = target[best]
            here[second] = -3
            after[best] = third
            before[third] = best
            rank[best] = SCORELESS
            rank[second] = SCORELESS
            left = before[best]
            left = left[here[left] >= 0]
            rank[left] = SCORELESS
            offer(np.concatenate([best, left]))
        held = ids[:, :width] >= 0
        n = held.sum(1)
        own = [self._finished(ids[r, :width].tolist(), units[r]) for r in np.nonzero(odd)[0].tolist()]
        n[odd] = [len(f) for f in own]
        plain, out = np.repeat(~odd, n), np.empty(n.sum(), dtype=np.int32)
        out[plain] = ids[:, :width][held & ~odd[:, None]]
        out[~plain] = list(chain.from_iterable(own))
        return out, n

    def _units(self, text: str) -> Iterator[list]:
        """Units of the text with its leading mark, in lists of bounded size; None is a literal mark."""
        at, first = 0, True
        while at < len(text) or first:
            end = at + CHUNK
            if end < len(text):
                # a chunk ends before a space that follows another character
                found = re.compile(r"(?<! ) ").search(text, end)
                end = found.start() if found else len(text)
            units: list = []
            for i, part in enumerate(text[at:end].split(SPACE)):
                if i:
                    units.append(None)
                part = part.replace(" ", SPACE)
                units.extend(self.pieces.unit.findall(SPACE + part if first and not i else part))
            yield units
            at, first = end, False

    def encode(self, texts: list[str | None], keys: list[int]) -> list[list[int] | None]:
        """Piece ids of each text; `keys` choose the draws of its units."""
        out: list = [None if t is None else [] for t in texts]
        waiting, chars = [], 0
        for i, (text, key) in enumerate(zip(texts, keys)):
            if not text:
                continue
            base, at = (key * 0x9E3779B97F4A7C15 + self.seed) & WORD, 0
            for units in self._units(text):
                drawn = _mix(np.uint64(base) + np.arange(at, at + len(units), dtype=np.uint64))
                if self.streams:
                    drawn %= np.uint64(self.streams)
                waiting.append((out[i], units, drawn))
                at += len(units)
                chars += 6 * len(units)
                if chars > CHUNK:
                    self._emit(waiting)
                    waiting, chars = [], 0
        self._emit(waiting)
        return out

    def _emit(self, waiting: list) -> None:
        units = list(chain.from_iterable(u for _, u, _ in waiting))
        if not units:
            return
        if len(self.known.numbers) > KEPT or self.known.ids.n > KEPT_IDS:
            self.known = _Agendas()
        known, numbers = self.known, self.known.numbers
        numbers.base, numbers.fresh = len(numbers), []
        unit = np.fromiter(map(numbers.__getitem__, units), dtype=np.int64, count=len(units))
        self._learn(numbers.fresh)
        draws = np.concatenate([d for _, _, d in waiting])
        first, n = known.id_first.rows[unit], known.id_n.rows[unit]
        before = known.ids.n  # the ids of occurrences follow those of units until they are handed out

        def place(at, ids, counts):
            first[at], n[at] = known.ids.n + np.cumsum(counts) - counts, counts
            known.ids.extend(ids)

        if self.dropout:
            key = self.keys(draws, known.hashes.rows[unit])
            hit = self._hit(unit, key)
            for part, width in _by_width(known.length.rows[unit[hit]]):
                at = hit[part]
                own = key[at]
                place(at, *self._agendas([units[i] for i in at.tolist()], width, lambda rows, start, middle, end: self.skipped(own[rows], start, middle, end)))
        for at in np.nonzero(known.length.rows[unit] > LONGEST_KEPT)[0].tolist():
            ids = self._heap(units[at], int(draws[at]))
            place(np.array([at]), ids, np.array([len(ids)]))
        ends = np.cumsum(n)
        flat = known.ids.rows[np.repeat(first - (ends - n), n) + np.arange(ends[-1])]
        known.ids.n = before
        at = begin = 0
        for ids, part, _ in waiting:
            at += len(part)
            end = int(ends[at - 1]) if at else 0
            ids.extend(flat[begin:end].tolist())
            begin = end

    def _hit(self, unit: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Occurrences that skip a candidate of their unit's agenda without skips."""
        known = self.known
        n = known.offer_n.rows[unit]
        some = np.nonzero(n)[0]
        if not len(some):
            return some
        n = n[some]
        begin = np.cumsum(n) - n
        offer = np.repeat(known.offer_first.rows[unit[some]] - begin, n) + np.arange(n.sum())
        skips = _mix(np.repeat(key[some], n) ^ known.mixed.rows[offer]) < np.uint64(self.limit)
        return some[np.logical_or.reduceat(skips, begin)]


def _by_width(length: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Places of units of similar length, in parts of bounded size, and their width; none of empty or very long units."""
    low = 0
    for width in WIDTHS:
        members = np.nonzero((length > low) & (length <= min(width, LONGEST_KEPT)))[0]
        step = max(1, (1 << 16) // width)
        for at in range(0, len(members), step):
            yield members[at : at + step], width
        low = width


ROWS = 256  # texts handed back at once


def encoded(docs: DataFrame, ident: str, text: str, model: str, dropout: float = 0.1, seed: int = 7) -> DataFrame:
    """Add `ids` (array<int>) and `lossless` (whether decoding gives the text again; null for a null text).

    `model` is a path every executor can read. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("ids", "lossless")]
    docs = docs.select(*kept)

    def step(batches):
        import gc

        import pyarrow as pa

        gc.disable()  # millions of small tuples and no cycles; scanning them for cycles takes a tenth of the time
        enc = Encoder(Pieces(model), dropout, seed)
        for big in batches:
            for at in range(0, big.num_rows, ROWS):
                batch = big.slice(at, ROWS)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                keys = [hash(k) if isinstance(k, int) else hash_text(repr(k)) for k in batch.column(batch.schema.get_field_index(ident)).to_pylist()]
                ids = enc.encode(texts, keys)
                same = [None if t is None else enc.pieces.decode(i) == t for t, i in zip(texts, ids)]
                arrays = [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "ids", "lossless"])
        gc.enable()

    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())])
    return docs.mapInArrow(step, schema)


def decoded(table: DataFrame, ids: str, model: str, out: str = "text") -> DataFrame:
    """Add `out`, the text of the ids (null for null)."""
    kept = [c for c in table.columns if c != out]
    table = table.select(*kept)

    def step(batches):
        import pyarrow as pa

        pieces = Pieces(model)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if x is None else pieces.decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return table.mapInArrow(step, T.StructType([*table.schema.fields, T.StructField(out, T.StringType())]))
