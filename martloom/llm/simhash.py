"""Near-duplicate detection with SimHash fingerprints and a Gray-order hierarchical index.

Fingerprint: the text's bytes with A-Z lower-cased are cut at ASCII white space, every shingle of k
words (repeats included; a shorter text is one shingle) is hashed with XXH64, and bit i is 1 if it is
set in over half of the hashes. A text without words has fingerprint zero. Null texts count as empty.

Index: two fingerprints with at most r differing bits agree in at least `blocks - r` of `blocks` bit
blocks. Every choice of that many blocks is a masked pattern at the top of the index, and all
fingerprints that share the pattern's bits form one group. A group too large for one task is divided
by further patterns over the bits left, so it is never searched whole. Inside a group the
fingerprints are sorted by Gray rank (neighbours differ in few bits), consecutive ones are gathered
into nodes, and each node stores the bits all its members share. Small groups are gathered into one index with a
root for each. A pair of nodes whose shared bits
already differ in more than r places is pruned as a whole; differences on the way down add up until
the fingerprints of two leaves are compared. A group yields a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.components import components
from martloom.session import materialise, sized

CHUNK = 1 << 18  # shingles hashed at once, so that one very long text needs bounded memory
PAIRS = 1 << 12  # node pairs opened at once
LEAF = 128  # fingerprints in a leaf node
FANOUT = 8  # nodes below an upper node
TWIG, FORK = 4, 4  # the same two sizes where many small groups share one index
GROUP_ROWS = 1 << 15  # fingerprints of a group searched by one task before it is divided further


def _bit_counts(words: np.ndarray) -> np.ndarray:
    """Set bits at each position over rows of 64-bit words, low bit first."""
    octets = np.ascontiguousarray(words).view(np.uint8).reshape(len(words), -1)
    if len(words) < 256:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    width = octets.shape[1]
    seen = np.bincount((octets + np.arange(width, dtype=np.int32) * 256).ravel(), minlength=256 * width).reshape(width, 256)
    table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return (seen @ table.astype(np.int64)).ravel()


def _widened(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """`lanes` independent words from each hash; the first is the hash itself."""
    out = np.empty((len(hashes), lanes), dtype=np.uint64)
    out[:, 0] = hashes
    for i in range(1, lanes):
        x = hashes * np.uint64(2 * i + 0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, i] = x ^ (x >> np.uint64(32))
    return out


def fingerprint(text: str | None, shingle: int, lanes: int = 1, seed: int = 42, words: list[bytes] | None = None) -> np.ndarray:
    """SimHash of one text as `lanes` words of 64 bits."""
    from xxhash import xxh64_intdigest

    if words is None:
        words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(lanes, dtype=np.uint64)
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64 * lanes, dtype=np.int64)
    for at in range(0, total, CHUNK):
        part = words[at : min(at + CHUNK, total) + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = max(1, len(part) - shingle + 1)
        last = ends[shingle - 1 :] if len(part) >= shingle else ends[-1:]
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())], dtype=np.uint64)
        counts += _bit_counts(_widened(hashes, lanes))
    return np.packbits(2 * counts > total, bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, text: str, keep: list[str], shingle: int, check_shingle: int = 0, check_lanes: int = 8) -> DataFrame:
    """`keep` columns, fp (long) and, with `check_shingle`, check (binary): a wider sketch over other shingles."""
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("fp", T.LongType())])
    if check_shingle:
        schema = schema.add(T.StructField("check", T.BinaryType()))

    def step(batches):
        import pyarrow as pa

        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                fps, checks = [], []
                for t in batch.column(len(keep)):
                    words = (t.as_py() or "").encode().lower().split()
                    fps.append(fingerprint(None, shingle, words=words))
                    if check_shingle:
                        checks.append(fingerprint(None, check_shingle, check_lanes, words=words).tobytes())
                columns = [*batch.columns[: len(keep)], pa.array(np.concatenate(fps).view(np.int64) if fps else [], pa.int64())]
                if check_shingle:
                    columns.append(pa.array(checks, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(step, schema)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each word in the reflected Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Level:
    """Nodes of one level: member ranges, the mask of bits all members share, and their values."""

    def __init__(self, first, last, mask, value):
        self.first, self.last, self.mask, self.value = first, last, mask, value

    @classmethod
    def over(cls, mask: np.ndarray, value: np.ndarray, first: np.ndarray) -> "_Level":
        every = np.bitwise_and.reduceat(value, first)
        some = np.bitwise_or.reduceat(value, first)
        shared = ~(every ^ some) & np.bitwise_and.reduceat(mask, first)
        return cls(first, np.append(first[1:], len(value)), shared, every & shared)


class _Forest:
    """Union-find over the members of a group that keeps the links which joined two sets."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []
        self.label = np.arange(n)  # of each member; members with equal labels are joined for sure

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        for i, j in zip(x.tolist(), y.tolist()):
            a, b = self.root(i), self.root(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self.links.append((i, j))

    def refresh(self) -> None:
        label = np.array(self.parent)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        self.label = label


def _uniform(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The common label of each run of members, -1 if they differ or one has none."""
    low, high = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first)
    return np.where(low == high, low, -1)


def group_links(fps: np.ndarray, radius: int, check: np.ndarray | None = None, check_radius: int = 0) -> list[tuple[int, int]]:
    """Spanning forest (index pairs) of the links between distinct fingerprints of one group.

    Leaves and their neighbours in Gray order are compared first; nodes that then are wholly in one
    component aren't compared with each other, so a dense group of copies costs little more than
    its size.
    """
    order = np.argsort(gray_rank(fps), kind="stable")
    sorted_fps = fps[order]
    sorted_check = None if check is None else check[order]
    full = np.full(len(fps), ~np.uint64(0))
    levels = [_Level.over(full, sorted_fps, np.arange(0, len(fps), LEAF))]
    while len(levels[-1].value) > 1:
        levels.append(_Level.over(levels[-1].mask, levels[-1].value, np.arange(0, len(levels[-1].value), FANOUT)))
    leaves, forest = levels[0], _Forest(len(fps))

    def compare(one: int, two: int) -> None:
        left, right = leaves.first[one], leaves.first[two]
        apart = np.bitwise_count(sorted_fps[left : leaves.last[one], None] ^ sorted_fps[None, right : leaves.last[two]])
        x, y = np.nonzero(apart <= radius)
        x, y = x + left, y + right
        new = (x < y) & (forest.label[x] != forest.label[y])
        x, y = x[new], y[new]
        if check is not None and len(x):
            alike = np.bitwise_count(sorted_check[x] ^ sorted_check[y]).sum(1) <= check_radius
            x, y = x[alike], y[alike]
        forest.join(x, y)

    for leaf in range(len(leaves.first)):
        compare(leaf, leaf)
        if leaf:
            forest.refresh()
            compare(leaf - 1, leaf)
    forest.refresh()
    wholes = [_uniform(forest.label, leaves.first)]
    for level in levels[1:]:
        wholes.append(_uniform(wholes[-1], level.first))
    a = b = np.zeros(1, dtype=np.int64)
    # of each pair of nodes: bits compared so far and the differences found in them
    seen, differ = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.uint8)
    for nodes, below, whole in zip(levels[:0:-1], levels[-2::-1], wholes[-2::-1]):
        a, b, seen, differ = _opened(nodes, below, a, b, seen, differ, radius, whole)
    far = b > a + 1
    for n, (one, two) in enumerate(zip(a[far].tolist(), b[far].tolist())):
        if n % 256 == 0:
            forest.refresh()
            whole = _uniform(forest.label, leaves.first)
        if whole[one] < 0 or whole[one] != whole[two]:
            compare(one, two)
    return [(int(order[i]), int(order[j])) for i, j in forest.links]


def _opened(nodes: _Level, below: _Level, a, b, seen, differ, radius: int, whole: np.ndarray | None = None) -> tuple:
    """Pairs of members of the node pairs (a, b) whose shared bits differ in at most `radius` places so far.

    Pairs wholly in one component (label in `whole`) are left out.
    """
    kept = []
    for at in range(0, len(a), PAIRS):
        here = slice(at, at + PAIRS)
        pair, x, y = _children(nodes, a[here], b[here])
        past, shared = seen[here][pair], below.mask[x] & below.mask[y]
        more = differ[here][pair] + np.bitwise_count((below.value[x] ^ below.value[y]) & shared & ~past)
        near = more <= radius
        if whole is not None:
            near &= (whole[x] != whole[y]) | (whole[x] < 0)
        kept.append((x[near], y[near], (past | shared)[near], more[near]))
    return tuple(np.concatenate(c) for c in zip(*kept)) if kept else (a, b, seen, differ)


def _runs(starts: np.ndarray, sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """First members of runs of at most `step` that end where a group ends, and the number of runs of each group."""
    counts = -(-sizes // step)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + step * place, counts


def batch_links(fps: np.ndarray, starts: np.ndarray, radius: int, check: np.ndarray | None = None, check_radius: int = 0) -> list[tuple[int, int]]:
    """Spanning forests (index pairs) of many small groups, which begin at `starts`, through one index with a root for each.

    The same search as in `group_links`, all groups a level at a time.
    """
    sizes = np.diff(np.append(starts, len(fps)))
    order = np.lexsort((gray_rank(fps), np.repeat(np.arange(len(starts)), sizes)))
    members = _Level(None, None, np.full(len(fps), ~np.uint64(0)), fps[order])
    levels, step = [members], TWIG
    while len(levels) == 1 or sizes.max() > 1:
        first, sizes = _runs(np.cumsum(sizes) - sizes, sizes, step)
        levels.append(_Level.over(levels[-1].mask, levels[-1].value, first))
        step = FORK
    a = b = np.arange(len(starts))
    seen, differ = np.zeros(len(a), dtype=np.uint64), np.zeros(len(a), dtype=np.uint8)
    for nodes, below in zip(levels[:0:-1], levels[-2::-1]):
        a, b, seen, differ = _opened(nodes, below, a, b, seen, differ, radius)
    x, y = order[a[a < b]], order[b[a < b]]
    if check is not None and len(x):
        alike = np.bitwise_count(check[x] ^ check[y]).sum(1) <= check_radius
        x, y = x[alike], y[alike]
    forest = _Forest(len(fps))
    forest.join(x, y)
    return forest.links


def _children(nodes: _Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (x <= y) of members of the node pairs (a, b), with the place of their node pair."""
    wa, wb = nodes.last[a] - nodes.first[a], nodes.last[b] - nodes.first[b]
    sizes = wa * wb
    pair = np.repeat(np.arange(len(a)), sizes)
    inner = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = nodes.first[a][pair] + inner // wb[pair]
    y = nodes.first[b][pair] + inner % wb[pair]
    keep = x <= y
    return pair[keep], x[keep], y[keep]


def _patterns(bits: int, radius: int, blocks: int) -> list[int]:
    """Masks over `bits`: every choice of blocks in which near fingerprints can't all differ."""
    places = [i for i in range(64) if bits >> i & 1]
    cuts = [round(i * len(places) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


ALL_BITS = (1 << 64) - 1


def fingerprint_links(distinct: DataFrame, radius: int, blocks: int, check_radius: int | None = None) -> DataFrame:
    """(a, b): a spanning set of links between distinct fingerprints, a != b.

    `distinct` has `fp` (and `check` if `check_radius` is given), each row once, rows told apart by `id`.
    Groups of more than GROUP_ROWS are divided by patterns over their free bits as long as bits are left. A group
    with f free bits has at most 2^f different fingerprints, so none stays above GROUP_ROWS.
    """
    cols = ["id", "fp"] + (["check"] if check_radius is not None else [])
    todo = distinct.select(*cols).withColumn("path", F.lit(0).cast("long")).withColumn("used", F.lit(0).cast("long"))
    masks, found = {0: _patterns(ALL_BITS, radius, blocks)}, None
    while True:
        steps = F.create_map(*[x for used, ms in masks.items() for x in (F.lit(_signed(used)), F.array(*[F.lit(_signed(m)) for m in ms]))])
        spread = todo.withColumn("mask", F.explode(steps[F.col("used")]))
        keyed = spread.select(
            *cols,
            # groups that share a hash by chance are searched together, which loses nothing
            F.xxhash64("path", "mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("path"),
            F.col("used").bitwiseOR(F.col("mask")).alias("used"),
        )
        counts = materialise(keyed.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max(F.bit_count(F.bitwise_not("used"))).alias("free")).filter("n > 1"), "group-sizes")
        large = (F.col("n") > GROUP_ROWS) & (F.col("free") > radius)
        # whole groups lie together in a task, and small ones are searched many at a time
        grouped = keyed.join(counts.filter(~large).select("path"), "path").repartition("path").sortWithinPartitions("path")
        links = materialise(grouped.select("path", *cols).mapInArrow(_search(radius, check_radius), "a long, b long"), "links")
        found = links if found is None else found.unionByName(links)
        divided = counts.filter(large).select("path")
        if divided.isEmpty():
            return found
        todo = materialise(keyed.join(divided, "path"), "large-groups")
        # at most the number of patterns; each depends on the bits already used
        masks = {r[0] & ALL_BITS: _patterns(ALL_BITS & ~r[0], radius, radius + 1) for r in todo.select("used").distinct().collect()}


BATCH = 1 << 13  # rows of small groups searched through one index


def _search(radius: int, check_radius: int | None):
    """Links within the groups of a sorted task; rows of one group may span batches."""

    def searched(path, ids, fps, check):
        import pyarrow as pa

        first = np.concatenate(([0], np.nonzero(path[1:] != path[:-1])[0] + 1))
        last = np.append(first[1:], len(path))
        links: list[tuple[int, int]] = []
        at = 0
        while at < len(first):
            # a group that fills leaves of its own, or as many smaller ones as make a batch
            stop = at + 1
            if last[at] - first[at] <= LEAF:
                stop = max(stop, int(np.searchsorted(last, first[at] + BATCH, side="right")))
                over = np.nonzero(last[at:stop] - first[at:stop] > LEAF)[0]
                stop = at + int(over[0]) if len(over) else stop
            a, b = int(first[at]), int(last[stop - 1])
            wide, limit = None if check is None else check[a:b], check_radius or 0
            if b - a > LEAF and stop == at + 1:
                found = group_links(fps[a:b], radius, wide, limit)
            else:
                found = batch_links(fps[a:b], first[at:stop] - a, radius, wide, limit)
            links.extend((a + i, a + j) for i, j in found)
            at = stop
        pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
        columns = [pa.array(ids[pairs[:, 0]], pa.int64()), pa.array(ids[pairs[:, 1]], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def step(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column(0).to_numpy(zero_copy_only=False)
            ids = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            fps = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            check = None
            if check_radius is not None:
                check = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
            now = [path, ids, fps, check]
            if held is not None:
                now = [None if one is None else np.concatenate([one, two]) for one, two in zip(held, now)]
            # the last group may go on in the next batch
            border = int(np.argmax(now[0] == now[0][-1]))
            if border:
                yield searched(*[None if c is None else c[:border] for c in now])
            held = [None if c is None else c[border:] for c in now]
        if held is not None:
            yield searched(*held)

    return step


def near_copies(docs: DataFrame, ident: str, text: str, shingle: int = 3, radius: int = 3, blocks: int = 4) -> DataFrame:
    """(`ident`, fp, component_id) for every row: the smallest `ident` reachable over links, itself included.

    Equal fingerprints are folded first, so copies cost one entry; nulls in `ident` are never a
    component's name unless the whole component has none.
    """
    printed = materialise(fingerprints(docs, text, [ident], shingle), "fingerprints")
    distinct = printed.groupBy("fp").agg(F.min(ident).alias("least"))
    distinct = materialise(distinct, "distinct-fingerprints").withColumn("id", F.col("fp"))
    links = fingerprint_links(distinct, radius, blocks)
    named = components(links, "fp")  # fp -> root, for linked fingerprints only
    rooted = distinct.select("fp", "least").join(sized(named), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.filter("root != fp or least is not null").groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, F.col("root") == F.col("_r"), "left").select(F.col("fp").alias("_fp"), "component_id")
    return printed.join(materialise(labels, "labels"), F.col("fp") == F.col("_fp"), "left").drop("_fp")


def one_of_each(docs: DataFrame, ident: str, text: str, shingle: int = 3, radius: int = 3, blocks: int = 4) -> DataFrame:
    """The rows of `docs` without near copies: the row with the smallest `ident` of each component stays.

    Components are those of `near_copies`. Repeated rows are copies of each other, and so are all texts without
    words; a null `ident` counts as smallest, and of equal ones one row stays.
    """
    names = docs.columns
    hidden = {c: f"_c{i}" for i, c in enumerate(names)}  # no clash with the columns added here
    plain = docs.select([F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
    printed = fingerprints(plain, hidden[text], list(hidden.values()), shingle)
    printed = materialise(printed.withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    distinct = printed.groupBy("fp").agg(F.min(F.struct(F.col(hidden[ident]).alias("i"), "_row")).alias("least"))
    distinct = materialise(distinct.withColumn("id", F.col("fp")), "distinct-fingerprints")
    named = components(fingerprint_links(distinct, radius, blocks), "id")
    rooted = distinct.select("id", "least").join(sized(named), "id", "left").withColumn("root", F.coalesce("root", "id"))
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least._row").alias("_kept"))
    # both sides grow with the data: a merge join at every size, not a broadcast at small ones
    stays = printed.join(materialise(kept, "kept-rows").hint("merge"), F.col("_row") == F.col("_kept"), "left_semi")
    return stays.select([F.col(h).alias(c) for c, h in hidden.items()])
