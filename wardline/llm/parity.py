"""Jaccard self-join by parity sketches.

A set of shingles is dealt by hash over m segments; a segment's sketch is the XOR of its shingles'
64-bit hashes. Every shingle of one set only changes one segment, so the number of segments that
differ is at most the size of the symmetric difference. Sets of similarity t and sizes a, b differ by at
most (1 - t)(a + b) / (1 + t) shingles; with more segments than that, at least one is equal, and equal
segments are a hash join. Sizes are banded, since the bound and so m depend on them. A bit sketch, some bits wide
for each shingle by which a pair may differ, bounds the difference again before a pair is verified on the sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import connected_components
from wardline.llm.tables import small
from wardline.llm.words import WordHasher, mix, signed, slices, window_hashes
from wardline.session import staged

BAND = 1.5
#: Sketch bits for each shingle by which a pair may differ: for testing pairs, and for rows that carry one beside each segment. Shingles
#: that differ hide in pairs on one bit; with 8 bits each, most pairs just beyond the threshold would be left possible.
WIDE, NARROW = 32, 32
WIDE_BITS, NARROW_BITS = (256, 1 << 17), (512, 2048)
#: Classes of one segment that meet in one task; a larger segment is cut into blocks that meet in pairs.
BLOCK = 2_048
_K = np.uint64(0x9E3779B97F4A7C15)


def band_starts(percent: int, upto: int) -> list[int]:
    """First sizes of the bands, the last beyond ``upto``."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND)))
    return starts


def segments(percent: int, stop: int) -> tuple[int, int]:
    """Most shingles by which a pair differs whose smaller set is below ``stop``, and the segments used.

    More segments than the difference plus one are taken, as empty ones join nothing.
    """
    small = stop - 1
    most = (100 - percent) * (small + small * 100 // percent) // (100 + percent)
    return most, most + 1 + (1 + math.ceil(0.06 * most) if most else 0)


def segment_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of one set of hashes: its own band's, and those of the lower bands that a pair may reach into."""
    n = len(shingles)
    starts = band_starts(percent, n)
    own = len(starts) - 2
    keys = []
    for band in range(own, -1, -1):
        if band != own and not n * percent < starts[band + 1] * 100:
            break
        most, m = segments(percent, starts[band + 1])
        at = (mix(shingles + np.array([band + 1], np.uint64) * _K) % np.uint64(m)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        filled = np.flatnonzero(np.bincount(at, minlength=m))
        xor = np.bitwise_xor.reduceat(shingles[order], np.searchsorted(at[order], filled))
        name = (np.uint64(band) << np.uint64(40)) + filled.astype(np.uint64)
        keys.append(mix(xor ^ mix(name * _K)))
        if m - len(filled) >= m - most:  # so many are empty that all equal ones may be
            empty = np.setdiff1d(np.arange(m), filled).astype(np.uint64)
            keys.append(mix(mix((np.uint64(band) << np.uint64(40)) + empty + np.uint64(1 << 39))))
    return np.concatenate(keys)


def sketch_bits(n: int, percent: int, factor: int, bounds: tuple[int, int]) -> int:
    """Bits of a sketch of ``n`` shingles: a power of two, so that a wider sketch folds into a narrower one."""
    wanted = factor * segments(percent, n + 1)[0]
    return min(max(1 << max(wanted - 1, 0).bit_length(), bounds[0]), bounds[1])


def bit_sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of ``bits`` bits, each the parity of the shingles that hash to it."""
    at = (mix(shingles * _K) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little")


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of ``size`` bytes of the same shingles: halves are put over each other."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def shingle_rows(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of every text; fewer words than ``size`` are one shingle."""
    hasher = WordHasher(11, fold=True)
    for i, j, data, offsets in slices(column):
        words = hasher.words(data, offsets)
        first, hashes = window_hashes(words, size)
        n_words = np.bincount(words.doc, minlength=j - i)
        by_doc = np.searchsorted(words.doc[first], np.arange(j - i + 1))
        starts = np.searchsorted(words.doc, np.arange(j - i))
        for k in range(j - i):
            if 0 < n_words[k] < size:
                short = mix(words.hash[starts[k] : starts[k] + n_words[k]] + np.uint64(n_words[k]))
                yield i + k, mix(np.array([np.bitwise_xor.reduce(short * np.arange(3, 3 + 2 * n_words[k], 2, dtype=np.uint64))]))
            else:
                yield i + k, np.unique(hashes[by_doc[k] : by_doc[k + 1]])


def _sketches(size: int, percent: int):
    """Size, name and wide bit sketch of every text's set."""
    def run(batches):
        for batch in batches:
            n_of, same, sketch = [], [], []
            for _, shingles in shingle_rows(batch.column(1), size):
                n = len(shingles)
                name = np.array([n, *[np.bitwise_xor.reduce(mix(shingles + np.uint64(s))) if n else 0 for s in (1, 2)]], np.uint64)
                n_of.append(n)
                same.append(name.tobytes())
                sketch.append(bit_sketch(shingles, sketch_bits(n, percent, WIDE, WIDE_BITS)).tobytes() if n else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_of, pa.int64()), pa.array(same, pa.binary()), pa.array(sketch, pa.binary())], ["id", "n", "same", "sketch"])
    return run


def _keys(size: int, percent: int):
    """A row for every segment of a set; of equal sets in a batch one is dealt."""
    def run(batches):
        for batch in batches:
            ids, seen = batch.column(0).to_pylist(), set()
            held, n = [], 0
            for k, shingles in shingle_rows(batch.column(1), size):
                name = shingles.tobytes() if len(shingles) < 64 else (len(shingles), *(int(np.bitwise_xor.reduce(mix(shingles + np.uint64(s)))) for s in (1, 2)))
                if ids[k] is None or not len(shingles) or name in seen:
                    continue
                seen.add(name)
                found = signed(segment_keys(shingles, percent))
                held.append((found, np.full(len(found), ids[k])))
                n += len(found)
                if n > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["segment", "id"])
                    held, n = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["segment", "id"])
    return run


def _shared(batches):
    """Of rows in order of (segment, id), those whose segment another id has too, beside the segment's first id and the one before.

    A partition's first and last rows stay in any case, as their neighbours are elsewhere.
    """
    held, before, lead = None, None, None  # the last row is held until the next is known; the one before it; its segment's first id

    def rows(segment, ids, first, last):
        return pa.RecordBatch.from_arrays([pa.array(segment), pa.array(ids), pa.array(first), pa.array(last)], ["segment", "id", "first", "last"])

    for batch in batches:
        segment, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if held is not None:
            segment, ids = np.append(held[0], segment), np.append(held[1], ids)
        new = np.ones(len(segment), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (ids[1:] != ids[:-1])
        segment, ids = segment[new], ids[new]  # without what repeats an id
        if not len(segment):
            continue
        start = np.ones(len(segment), bool)
        start[1:] = segment[1:] != segment[:-1]
        at = np.maximum.accumulate(np.where(start, np.arange(len(segment)), 0))
        first, last = ids[at], np.where(start, ids, np.roll(ids, 1))
        if before is not None and segment[0] == before[0]:  # the first segment began earlier
            first[at == 0], last[0] = lead, before[1]
        keep = ~start
        keep[:-1] |= ~start[1:]
        keep[0] |= before is None or segment[0] == before[0]
        keep[-1] = False
        yield rows(segment[keep], ids[keep], first[keep], last[keep])
        if len(segment) > 1:
            before = (segment[-2], ids[-2])
        lead = first[-1]
        held = (segment[-1], ids[-1])
    if held is not None:
        same = before is not None and before[0] == held[0]
        yield rows([held[0]], [held[1]], [lead if same else held[1]], [before[1] if same else held[1]])


def _possible(percent: int):
    """Whether sizes and wide sketches leave a pair possible."""
    def run(n, sketch, n2, sketch2):
        out = []
        for a, x, b, y in zip(n.to_pylist(), sketch, n2.to_pylist(), sketch2):
            x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
            size = min(len(x), len(y))
            differ = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
            out.append(differ * (100 + percent) <= (a + b) * (100 - percent))
        return pa.array(out, pa.bool_())
    return F.arrow_udf(run, "boolean")


def _narrow(percent: int):
    def run(n, sketch):
        return pa.array([folded(np.frombuffer(v.as_buffer(), np.uint8), sketch_bits(a, percent, NARROW, NARROW_BITS) // 8).tobytes()
                         for a, v in zip(n.to_pylist(), sketch)], pa.binary())
    return F.arrow_udf(run, "binary")


def _apart_pairs(percent: int, rows_at_once: int = 20_000, pairs_at_once: int = 100_000):
    """Rows in order of (segment, i, j): pairs of classes of one segment, of different components, that sizes and narrow
    sketches leave possible. Where i and j differ, only pairs of a class of block i and one of block j."""
    def pairs_of(table: pa.Table):
        segment, i, j, block, node, component, n = (table.column(c).to_numpy() for c in ("segment", "i", "j", "block", "node", "component", "n"))
        raw = [np.frombuffer(v, np.uint8) for v in table.column("sketch").to_pylist()]
        level = np.array([len(v) for v in raw])
        levels = {}
        for size in np.unique(level):
            place = np.full(len(raw), -1)
            wide = np.flatnonzero(level >= size)
            place[wide] = np.arange(len(wide))
            levels[size] = place, np.stack([folded(raw[r], size) for r in wide])
        start = np.ones(len(segment), bool)
        start[1:] = (segment[1:] != segment[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        end = np.append(np.flatnonzero(start)[1:], len(segment))[np.cumsum(start) - 1]
        count = end - np.arange(len(segment)) - 1  # each row meets the later ones of its group
        ahead = np.concatenate([[0], np.cumsum(count)])
        a = 0
        while a < len(count):
            b = max(int(np.searchsorted(ahead, ahead[a] + pairs_at_once, "right")) - 1, a + 1)
            x = np.repeat(np.arange(a, b), count[a:b])
            y = x + 1 + np.arange(len(x)) - np.repeat(ahead[a:b] - ahead[a], count[a:b])
            some = ((component[x] != component[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
                    & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent))
            x, y = x[some], y[some]
            differ = np.zeros(len(x), np.int64)
            least = np.minimum(level[x], level[y])
            for size, (place, matrix) in levels.items():
                mine = np.flatnonzero(least == size)
                differ[mine] = np.bitwise_count(matrix[place[x[mine]]] ^ matrix[place[y[mine]]]).sum(axis=1, dtype=np.int64)
            near = differ * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
            u, v = node[x[near]], node[y[near]]
            pair = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1) if len(u) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["node", "node2"])
            a = b

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if n >= rows_at_once:  # up to where the last group ends
                last = [held[-1].column(c)[-1].as_py() for c in ("segment", "i", "j")]
                other = np.flatnonzero(np.any([batch.column(c).to_numpy(zero_copy_only=False) != x for c, x in zip(("segment", "i", "j"), last)], axis=0))
                if len(other):
                    held.append(batch.slice(0, int(other[0])))
                    yield from pairs_of(pa.Table.from_batches(held))
                    held, n, batch = [], 0, batch.slice(int(other[0]))
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held:
            yield from pairs_of(pa.Table.from_batches(held))
    return run


def _sets(size: int, held_at_once: int = 500_000):
    def run(batches):
        for batch in batches:
            first, rows, held = 0, [], 0
            for k, s in shingle_rows(batch.column(1), size):
                rows.append(signed(s))
                held += len(s)
                if held > held_at_once or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), pa.array(rows, pa.list_(pa.int64()))], ["id", "shingles"])
                    first, rows, held = k + 1, [], 0
    return run


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85,
                rounds: int = 2, block: int = BLOCK) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row of ``df``.

    Rows are linked when their sets of ``size``-word shingles (A-Z folded) have at least ``percent``
    hundredths of their union in common; the component is the smallest key reachable by links, the own
    one included. Null and empty texts have no shingles and link with nothing. Rows that repeat a key
    are one document of several texts: they share their links. A row with a null key shares the component of
    its equals and has none without them. Shingles are compared by 64-bit hashes. Other columns are not read.

    Sets that are equal are one class. Of the classes of a segment first each is compared with the first one (and in
    the second of ``rounds`` with the one before), which links most families; then all pairs that are not yet in one component,
    so no link is lost. Bit sketches as wide as the sizes need sort out pairs before any set is read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    sketches = staged(rows.mapInArrow(_sketches(size, percent), "id bigint, n bigint, same binary, sketch binary"), "sketches")
    heads = staged(sketches.where("n > 0").groupBy("same").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
                   .where("node is not null"), "classes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = staged(rows.mapInArrow(_keys(size, percent), "segment bigint, id bigint")
                    .repartitionByRange(parts, "segment", "id").sortWithinPartitions("segment", "id")
                    .mapInArrow(_shared, "segment bigint, id bigint, first bigint, last bigint"), "segments")
    # Ids that stand for another one's class; others are their own node.
    moved = small(staged(sketches.where("n > 0").join(heads.select("same", "node"), "same").where("id != node")
                         .select("id", "node").distinct(), "moved"))

    def to_node(rows_, column):
        named = rows_.join(moved.withColumnsRenamed({"id": column, "node": "_node"}), column, "left")
        return named.withColumn(column, F.coalesce("_node", column)).drop("_node")

    stars = shared.select("id", F.explode(F.array(*["first", "last"][:rounds])).alias("lead")).where("id != lead").distinct()
    stars = to_node(to_node(stars, "id"), "lead").where("id != lead").select(F.col("id").alias("node"), F.col("lead").alias("node2"))
    links = _verified(rows, _sorted_out(stars, heads, percent), size, percent)
    found = staged(connected_components(links.select(F.col("node").alias("u"), F.col("node2").alias("v"))), "components")

    placed = to_node(shared.select("segment", "id"), "id").withColumnRenamed("id", "node")
    placed = placed.join(small(found.withColumnRenamed("id", "node")), "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_segments = (placed.groupBy("segment").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
                     .where("lo != hi").select("segment", F.ceil(F.col("members") / block).alias("blocks")))
    apart = staged(placed.join(open_segments, "segment"), "apart")
    sides = heads.select("node", "n", _narrow(percent)("n", "sketch").alias("sketch"))
    shard = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    meeting = (apart.join(sides, "node").withColumn("block", shard).withColumn("_other", other)
               .select("segment", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"), "block", "node", "component", "n", "sketch"))
    by = ["segment", "i", "j"]
    rest = meeting.repartition(*by).sortWithinPartitions(*by).mapInArrow(_apart_pairs(percent), "node bigint, node2 bigint").distinct()
    bridges = _verified(rows, _sorted_out(rest, heads, percent), size, percent)
    names = small(found.withColumnsRenamed({"id": "node", "component": "_c"}))

    def to_component(rows_, column):
        return rows_.join(names.withColumnRenamed("node", column), column, "left").withColumn(column, F.coalesce("_c", column)).drop("_c")

    joined = staged(connected_components(to_component(to_component(bridges.select("node", "node2"), "node"), "node2").toDF("u", "v")), "bridges")
    final = (found.withColumnRenamed("id", "node").join(joined.select(F.col("id").alias("component"), F.col("component").alias("root")), "component", "left")
             .select("node", F.coalesce("root", "component").alias("root"))
             .unionByName(joined.join(found.select("id"), "id", "left_anti").select(F.col("id").alias("node"), F.col("component").alias("root"))))
    named = (heads.select("same", "node").join(final, "node", "left")
             .select("same", F.coalesce("root", "node").alias("root")))
    return sketches.select("id", "n", "same").join(named, "same", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def _sorted_out(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and wide sketches leave possible."""
    sides = heads.select("node", "n", "sketch")
    both = pairs.join(sides, "node").join(sides.toDF("node2", "n2", "sketch2"), "node2")
    both = both.where(F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
    return both.where(_possible(percent)("n", "sketch", "n2", "sketch2")).select("node", "node2")


def _verified(rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough; only the texts that a pair names are read again."""
    pairs = staged(pairs.select(F.least("node", "node2").alias("node"), F.greatest("node", "node2").alias("node2"))
                   .where("node != node2").distinct(), "pairs")
    asked = pairs.select(F.col("node").alias("id")).unionByName(pairs.select(F.col("node2").alias("id"))).distinct()
    sets = staged(rows.join(small(staged(asked, "asked")), "id", "left_semi").mapInArrow(_sets(size), "id bigint, shingles array<bigint>"), "sets")
    first = sets.select(F.col("id").alias("node"), F.col("shingles").alias("a"))
    second = sets.select(F.col("id").alias("node2"), F.col("shingles").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return staged(pairs.join(first, "node").join(second, "node2")
                  .where(common * (100 + percent) >= (F.size("a") + F.size("b")) * percent).drop("a", "b"), "links")
