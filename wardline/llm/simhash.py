"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints that differ in at most k bits are cut into k + 1 blocks. In some rotation of the blocks the
first has no error, the first two at most one, and so on up to k: the errors' running sums stay below a line from
nothing to k for one of the starting points. Hence k + 1 tries, one for each rotation, are walked with an error
budget that grows from block to block; a pair of nodes goes on to its children's pairs with the differing bits so
far, and ends where they exceed the budget. The first block has no budget, so subtrees below it are what
tasks hold; a subtree with many fingerprints is cut into pairs of deeper nodes first.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import connected_components
from wardline.llm.tables import small
from wardline.llm.words import cut
from wardline.session import staged

BITS = 64
#: Fingerprints of a subtree that one task takes; pairs of nodes walked at once; pairs of leaves compared directly.
SUBTREE, WALK, DIRECT = 16_384, 16_384, 64
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_ONE = np.uint64(1)


def _shingle_hashes(text: bytes, size: int, seed: int):
    """Arrays of the hashes of all shingles, a block of the text at a time."""
    carried: list[bytes] = []
    any_full = False
    for block in cut(text.translate(_FOLD), _GAP):
        words = carried + block.split()
        if len(words) >= size:
            any_full = True
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            starts = np.cumsum(sizes) - sizes
            stops = (starts + sizes - 1)[size - 1 :]
            yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())),
                              np.uint64, len(stops))
        carried = words[-(size - 1) :] if size > 1 else []
    if carried and not any_full:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed)], np.uint64)


def fingerprint(text: bytes, size: int = 4, seed: int = 42) -> int:
    """A bit is 1 if over half the text's shingle hashes have it; shingles repeat, A-Z count as a-z."""
    n, ones = 0, np.zeros(BITS, np.int64)
    for h in _shingle_hashes(text, size, seed):
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _fingerprints(size: int, seed: int):
    def run(column: pa.Array) -> pa.Array:
        texts = column.cast(pa.large_binary()).fill_null(b"").to_pylist()
        return pa.array([fingerprint(t, size, seed) for t in texts], pa.int64())
    return run


# --- tries ---

def block_ends(distance: int, rotation: int) -> list[int]:
    """Depths at which the blocks of a rotated fingerprint end."""
    sizes = [BITS // (distance + 1) + (k < BITS % (distance + 1)) for k in range(distance + 1)]
    return np.cumsum(sizes[rotation:] + sizes[:rotation]).tolist()


def rotation_starts(distance: int) -> list[int]:
    return [0, *block_ends(distance, 0)[:-1]]


def budgets(distance: int) -> np.ndarray:
    """``[rotation, depth]``: differing bits that a pair of nodes of a depth may have."""
    return np.array([[0, *np.searchsorted(block_ends(distance, r), np.arange(1, BITS + 1))] for r in range(distance + 1)])


def masks(distance: int, rotation: int, depth: int) -> list[int]:
    """By what the prefixes of two nodes of a depth may differ, as numbers."""
    allowed = budgets(distance)[rotation]
    found = [0]
    for d in range(1, depth + 1):
        found = [2 * m + b for m in found for b in (0, 1) if (2 * m + b).bit_count() <= allowed[d]]
    return sorted(found)


class _Links:
    """Classes of fingerprints that are already linked, and the links that made them."""

    def __init__(self, rows: np.ndarray, n: int):
        self.rows, self.label, self.found = rows, np.arange(n), []
        self._note()

    def _note(self):
        self.row_label = self.label[self.rows]
        self.changes = np.concatenate([[0], np.cumsum(self.row_label[1:] != self.row_label[:-1])])

    def one(self, a0, a1, b0, b1) -> np.ndarray:
        """Whether all leaves of both nodes are linked already."""
        return ((self.changes[a1 - 1] == self.changes[a0]) & (self.changes[b1 - 1] == self.changes[b0])
                & (self.row_label[a0] == self.row_label[b0]))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links between rows; of those between the same two classes one is kept."""
        x, y = self.row_label[i], self.row_label[j]
        _, first = np.unique(np.minimum(x, y) * len(self.label) + np.maximum(x, y), return_index=True)
        first = first[x[first] != y[first]]
        if not len(first):
            return
        self.found.append((self.rows[i[first]], self.rows[j[first]]))
        x, y, parent = x[first], y[first], np.arange(len(self.label))
        while (parent[x] != parent[y]).any():
            least = np.minimum(parent[x], parent[y])
            np.minimum.at(parent, parent[x], least)
            np.minimum.at(parent, parent[y], least)
            while (parent[parent] != parent).any():
                parent = parent[parent]
        self.label = parent[self.label]
        self._note()


def _first_at_least(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where, in each ascending run of keys, those of at least ``least`` begin."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        below = open_ & (key[np.minimum(mid, len(key) - 1)] < least)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
    return lo


def _children(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the second child of each node begins: the keys with the bit at ``depth`` set."""
    bit = _ONE << (BITS - 1 - depth).astype(np.uint64)
    return _first_at_least(key, lo, hi, (key[lo] & ~(bit | (bit - _ONE))) | bit)


def _compare(pairs, key: np.ndarray, distance: int, links: _Links) -> None:
    a0, a1, b0, b1 = pairs[:4]
    wide = b1 - b0
    count = (a1 - a0) * wide
    pair = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
    i, j = a0[pair] + at // wide[pair], b0[pair] + at % wide[pair]
    near = (i != j) & (np.bitwise_count(key[i] ^ key[j]) <= distance)
    if near.any():
        links.add(i[near], j[near])


def walk(key: np.ndarray, start: np.ndarray, distance: int, links: _Links) -> None:
    """Link the keys of pairs of nodes that differ in at most ``distance`` bits.

    ``start`` has a column for each pair: first and past-last row of both nodes, differing bits, depth, rotation. The
    most recent pairs are walked first and some at a time, so that what waits stays short, and a pair whose leaves
    have become one class is left out.
    """
    allowed, waiting = budgets(distance), [start]
    while waiting:
        pairs = waiting.pop()
        if pairs.shape[1] > WALK:
            waiting.append(pairs[:, WALK:])
            pairs = pairs[:, :WALK]
        pairs = pairs[:, ~links.one(*pairs[:4])]
        few = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) <= DIRECT
        if few.any():
            _compare(pairs[:, few], key, distance, links)
        pairs = pairs[:, ~few & (pairs[5] < BITS)]
        if not pairs.shape[1]:
            continue
        a0, a1, b0, b1, differ, depth, rotation = pairs
        am, bm = _children(key, a0, a1, depth), _children(key, b0, b1, depth)
        same, more = (a0 == b0) & (a1 == b1), differ + 1
        crossed = np.concatenate([np.stack([a0, am, bm, b1, more, depth + 1, rotation]),
                                  np.stack([am, a1, b0, bm, more, depth + 1, rotation])[:, ~same]], axis=1)
        straight = np.concatenate([np.stack([a0, am, b0, bm, differ, depth + 1, rotation]),
                                   np.stack([am, a1, bm, b1, differ, depth + 1, rotation])], axis=1)
        for nodes in (crossed, straight):
            nodes = nodes[:, (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (nodes[4] <= allowed[nodes[6], nodes[5]])]
            if nodes.shape[1]:
                waiting.append(nodes)


def _link_nodes(distance: int, rows_at_once: int = 200_000):
    """Rows in order of (rotation, depth, low, high, key): the pairs of nodes, with the keys of both."""
    def links_of(table: pa.Table) -> pa.RecordBatch:
        rotation, depth, low, high, key, node = (c.to_numpy() for c in table.columns)
        key = key.view(np.uint64)
        names, rows = np.unique(node, return_inverse=True)
        links = _Links(rows, len(names))
        new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (depth[1:] != depth[:-1]) | (rotation[1:] != rotation[:-1])]))
        stop = np.append(new[1:], len(key))
        lo, hi, d = low[new].view(np.uint64), high[new].view(np.uint64), depth[new].astype(np.int64)
        middle = np.where(lo == hi, stop, _first_at_least(key, new, stop, hi << (BITS - d).astype(np.uint64)))
        self_ = lo == hi
        start = np.stack([new, middle, np.where(self_, new, middle), stop, np.bitwise_count(lo ^ hi).astype(np.int64), d, rotation[new].astype(np.int64)])
        walk(key, start[:, (start[0] < start[1]) & (start[2] < start[3])], distance, links)
        u, v = (np.concatenate([f[k] for f in links.found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(names[u]), pa.array(names[v])], ["u", "v"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if n >= rows_at_once:
                name = [batch.column(i) for i in range(4)]
                last = [held[-1].column(i)[-1].as_py() for i in range(4)]
                other = np.flatnonzero(np.any([c.to_numpy(zero_copy_only=False) != x for c, x in zip(name, last)], axis=0))
                if len(other):  # the pair that was begun ends before this row
                    held.append(batch.slice(0, int(other[0])))
                    yield links_of(pa.Table.from_batches(held))
                    held, n, batch = [], 0, batch.slice(int(other[0]))
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held:
            yield links_of(pa.Table.from_batches(held))
    return run


def node_pairs(prints: DataFrame, distance: int, subtree: int = SUBTREE) -> DataFrame:
    """Rows of ``prints(fingerprint, node)`` under every pair of trie nodes that one task takes.

    A node is a rotation's subtree below the first block; one with more than ``subtree`` fingerprints is
    cut at the first of a few depths at which no part is larger, and its rows go to every pair of parts that the budget
    allows: 14 copies at most within two blocks of 13 bits, some hundreds in the third. Below that a part has 2**25
    fingerprints at most.
    """
    def rotated(start):
        f = F.col("fingerprint")
        return f if not start else F.shiftleft(f, start).bitwiseOR(F.shiftrightunsigned(f, BITS - start))

    ends = [block_ends(distance, r) for r in range(distance + 1)]
    tries = prints.select("node", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rotation"), rotated(s).alias("key"), F.lit(ends[r][0]).alias("depth"))
        for r, s in enumerate(rotation_starts(distance))])).alias("t")).select("t.*", "node")

    def top(bits):  # of the key; `bits` a column or number below 64
        return F.shiftrightunsigned(F.col("key"), BITS - bits)

    tries = tries.withColumn("low", F.expr(f"case rotation {' '.join(f'when {r} then shiftrightunsigned(key, {BITS - e[0]})' for r, e in enumerate(ends))} end") if distance else F.lit(0))
    crowded = staged(tries.groupBy("rotation", "low").count().where(F.col("count") > subtree).drop("count"), "crowded")
    light = tries.select("rotation", "depth", "low", F.col("low").alias("high"), "key", "node")
    if crowded.isEmpty():
        return light
    crowded = small(crowded)
    light = light.join(crowded, ["rotation", "low"], "left_anti").select(light.columns)
    heavy = staged(tries.join(crowded, ["rotation", "low"], "left_semi"), "heavy")
    cut_depths = [[min(e[0] + 5, e[1]), min(e[0] + 9, e[1]), e[1], *e[2:3]] for e in ends]
    sizes = [F.expr(f"case rotation {' '.join(f'when {r} then shiftrightunsigned(key, {BITS - c[k]})' for r, c in enumerate(cut_depths))} end")
             for k in range(len(cut_depths[0]))]
    chosen = None
    for k in range(len(sizes) - 1):
        most = heavy.groupBy("rotation", "low", sizes[k].alias("part")).count().groupBy("rotation", "low").agg((F.max("count") <= subtree).alias(f"fits{k}"))
        chosen = most if chosen is None else chosen.join(most, ["rotation", "low"])
    level = F.lit(len(sizes) - 1)
    for k in reversed(range(len(sizes) - 1)):
        level = F.when(F.col(f"fits{k}"), F.lit(k)).otherwise(level)
    chosen = small(staged(chosen.select("rotation", "low", level.alias("level")), "levels"))
    leveled = heavy.drop("depth").join(chosen, ["rotation", "low"])
    out = light
    for r in range(distance + 1):
        for k, depth in enumerate(cut_depths[r]):
            part = top(depth)
            pairs = (leveled.where((F.col("rotation") == r) & (F.col("level") == k)).withColumn("part", part)
                     .withColumn("other", F.explode(F.array(*[F.col("part").bitwiseXOR(F.lit(m).cast("bigint")) for m in masks(distance, r, depth)]))))
            out = out.unionByName(pairs.select("rotation", F.lit(depth).alias("depth"), F.least("part", "other").alias("low"),
                                               F.greatest("part", "other").alias("high"), "key", "node"))
    return out


def linked_prints(prints: DataFrame, distance: int = 4, subtree: int = SUBTREE) -> DataFrame:
    """Links ``(u, v)`` between nodes of ``prints(fingerprint, node)``, each fingerprint once, that connect all whose
    fingerprints differ in at most ``distance`` bits. Links that add nothing to a task's classes are left out."""
    if distance == 0:
        return prints.sparkSession.createDataFrame([], "u bigint, v bigint")
    pairs = node_pairs(prints, distance, subtree)
    names = ["rotation", "depth", "low", "high"]
    return (pairs.repartition(*names).sortWithinPartitions(*names, "key")
            .select(*names, "key", "node").mapInArrow(_link_nodes(distance), "u bigint, v bigint"))


def near_prints(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row of ``df``; the fingerprint as a whole number.

    Rows are linked when their fingerprints differ in at most ``distance`` (0 to 7) of 64 bits; the component is the
    smallest key reachable by links, the own one included. Fewer words than ``size`` are one shingle; null and
    empty texts have fingerprint zero and link like any other. Rows that repeat a key are texts of their own. A row
    with a null key shares the component of the rows with its fingerprint, links nothing, and has a null component
    without them. An empty table gives no rows; other columns are not read.
    """
    if not 0 <= distance <= 7:
        raise ValueError("distance must be 0 to 7")
    rows = staged(df.select(F.col(key).cast("bigint").alias("id"), F.arrow_udf(_fingerprints(size, seed), "bigint")(F.col(text)).alias("fingerprint")), "fingerprints")
    prints = staged(rows.groupBy("fingerprint").agg(F.min("id").alias("node"), F.count("*").alias("n")).where("node is not null"), "prints")
    # Keys that repeat with several fingerprints are nodes of several; links go by the fingerprint.
    links = staged(linked_prints(prints.select("fingerprint", F.col("fingerprint").alias("node")), distance), "links")
    found = connected_components(links).withColumnsRenamed({"id": "fingerprint", "component": "group"})
    joined = prints.join(small(staged(found, "components")), "fingerprint", "left")
    least = joined.where("group is not null").groupBy("group").agg(F.min("node").alias("root"))
    named = (joined.join(small(staged(least, "roots")), "group", "left").where("n > 1 or root is not null")
             .select("fingerprint", F.coalesce("root", "node").alias("root")))
    return rows.join(small(staged(named, "named")), "fingerprint", "left").select(
        F.col("id").alias(key), "fingerprint", F.coalesce("root", "id").alias("component_id"))
