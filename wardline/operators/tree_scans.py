"""Growing tree ensembles by scans over binned rows.

Same method as the library's classifiers: at most 32 bins a feature, cut at quantiles of a bounded sample; a scan a level counts
every bin of every open node, and the split of largest gain is taken. Rows are packed once, a byte a feature, in blocks; a task
adds up whole blocks in a few array operations, where the library adds a row and a feature at a time. What leaves a task are counts of
bins, bounded by nodes and bins; the best splits of a forest are chosen by tasks, too. A fit ends as a model of the library.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from wardline.session import shared_folder, work_path

# Executors get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a feature, and rows of the sample whose quantiles cut them; as in the library.
BINS, SAMPLE = 32, 10_000
#: Rows of a block; combinations of bins that are counted as one column.
BLOCK, CELLS = 65_536, 1_024
#: Rows whose bins are looked up at once.
NEAR = 4_096
#: Trees of a forest that grow together; trees of a boosted ensemble between two checkpoints; parts whose sums the driver adds itself.
GROUP, CHECKPOINT, DIRECT = 25, 20, 64
#: A node of less impurity is pure.
PURE = 2.0**-52
STORED = ("tree int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
          "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


class Node:
    """A node while its tree grows; ``stats`` are what its rows add up to, ``cut`` the last bin that goes left."""

    __slots__ = ("feature", "cut", "left", "right", "gain", "count", "stats")

    def __init__(self, count=0.0, stats=None):
        self.feature, self.cut, self.left, self.right, self.gain, self.count, self.stats = -1, 0, -1, -1, -1.0, count, stats


class Shape(NamedTuple):
    """Nodes as arrays; a leaf points to itself. ``slot`` numbers the open nodes, all others have the number after the last."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    slot: np.ndarray


def shape(nodes: Sequence[Node], active: Sequence[int]) -> Shape:
    child = np.array([(n.left, n.right) if n.feature >= 0 else (i, i) for i, n in enumerate(nodes)], np.int64).ravel()
    slot = np.full(len(nodes), len(active), np.int64)
    slot[list(active)] = np.arange(len(active))
    return Shape(np.array([max(n.feature, 0) for n in nodes], np.int64), np.array([n.cut for n in nodes], np.uint8), child, slot)


def cuts_of(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between the distinct values, or near even shares of the weight where there are more than bins."""
    found, at = np.unique(values, return_inverse=True)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    below = np.cumsum(np.bincount(at, weights))
    stride, cuts = below[-1] / bins, []
    target = stride
    for i in range(1, len(found)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            cuts.append(middle[i - 1])
            target += stride
    return np.array(cuts[: bins - 1])


def find_cuts(rows: DataFrame, total: int, class_weights: Sequence[float], seed: int) -> list[np.ndarray]:
    some = rows.sample(False, SAMPLE / total, seed) if total > SAMPLE else rows
    table = some.toArrow()
    x, y = _matrix(table.column(0).combine_chunks(), table.num_rows), table.column(1).to_numpy().astype(int)
    weights = np.asarray(class_weights, float)[y]
    return [cuts_of(x[:, f], weights) for f in range(x.shape[1])]


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def binned(rows: DataFrame, cuts: Sequence[np.ndarray]) -> RDD:
    """``rows(x array<double>, y double)`` as blocks ``(number, bins, labels)``: a byte a feature, row by row."""
    width = len(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0

        def block():
            x, y = (np.concatenate(v) for v in zip(*parts))
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["x", "y"])

        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), batch.num_rows)
                bins = np.empty((len(x), width), np.uint8)
                for f, c in enumerate(cuts):
                    bins[:, f] = np.searchsorted(c, x[:, f], "left")
                parts.append((bins, batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)))
                n += len(x)
            if n >= BLOCK:
                yield block()
                parts, n = [], 0
        if n:
            yield block()

    def numbered(part, blocks):
        for i, (x, y) in enumerate(blocks):
            yield (part << 24) + i, bytes(x), bytes(y)

    blocks = rows.mapInArrow(pack, "x binary, y binary").rdd.mapPartitionsWithIndex(numbered)
    # A task holds one block at a time, and starting it takes longer than a few blocks do: a part a core.
    return blocks.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def purity_gain(total, left, right, size):
    """Gain of Gini splits from the classes' weights on the last axis; ``size`` adds an axis up."""
    def gini(c):
        w = size(c)
        return w, 1.0 - np.divide((c * c).sum(-1), w * w, out=np.ones_like(w), where=w > 0)
    (w, whole), (wl, low), (wr, high) = gini(total), gini(left), gini(right)
    return whole - np.divide(wl * low + wr * high, w, out=np.zeros_like(wl), where=w > 0)


def prune(nodes: list[Node], prediction) -> None:
    """Two leaves that predict the same become one, from the lowest up; as in the library."""
    for node in reversed(nodes):
        if node.feature >= 0:
            low, high = nodes[node.left], nodes[node.right]
            if low.feature < 0 and high.feature < 0 and prediction(low) == prediction(high):
                node.feature, node.left, node.right, node.gain = -1, -1, -1, -1.0


# A forest.

def poisson_table() -> np.ndarray:
    """Counts of a Poisson draw of mean 1 by a number of 16 bits."""
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(steps * 65_536, np.arange(65_536) + 0.5).astype(np.uint8)


def _unpacked(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Counts ``(node, place, bin, class)`` from those of the bins that there are."""
    out = np.zeros((*sizes.shape, BINS, 2))
    out[np.arange(BINS) < sizes[..., None]] = flat.reshape(-1, 2)
    return out


def best_of_forest(flat: np.ndarray, asked: np.ndarray, sizes: np.ndarray, class_weights: np.ndarray, least: int):
    """For every open node its classes' counts, and of its best split the feature, the last bin on the left, the gain and the left
    counts; the feature is -1 where no split helps."""
    counts = _unpacked(flat, sizes)
    total = counts[:, 0].sum(1)
    left = counts.cumsum(2)[:, :, :-1]
    right = total[:, None, None] - left
    gain = purity_gain((total * class_weights)[:, None, None], left * class_weights, right * class_weights, lambda c: c.sum(-1))
    able = (np.arange(BINS - 1) < sizes[..., None] - 1) & (left.sum(-1) >= least) & (right.sum(-1) >= least) & (gain > 0)
    weighted = total * class_weights
    w = weighted.sum(-1)
    able &= (1.0 - (weighted**2).sum(-1) / np.where(w > 0, w * w, 1.0) >= PURE)[:, None, None]
    gain = np.where(able, gain, -1.0).reshape(len(total), -1)
    at = gain.argmax(1)
    node = np.arange(len(total))
    place, cut = np.divmod(at, BINS - 1)
    best = gain[node, at]
    return total, np.where(best > 0, asked[node, place], -1), cut, best, left[node, place, cut]


def grow_forest(blocks: RDD, cuts: Sequence[np.ndarray], trees: int, depth: int, least: int, class_weights: Sequence[float], seed: int,
                bootstrap: bool = True, subset: int | None = None) -> list[list[Node]]:
    """Trees on rows drawn with replacement, by a hash of seed, tree and block; a node looks at ``subset`` features, the root of their number
    if not given. Some trees grow together, a scan a level; nothing is kept of a row but its bins."""
    width, weights = len(cuts), np.asarray(class_weights, float)
    places = subset or (width if trees == 1 else math.ceil(math.sqrt(width)))
    sizes_of = np.array([len(c) + 1 for c in cuts])
    parts, out, draws = blocks.getNumPartitions(), [], poisson_table()
    for start in range(0, trees, GROUP):
        forest = {t: [Node()] for t in range(start, min(start + GROUP, trees))}
        active = {t: [0] for t in forest}
        for level in range(depth):
            plans = {}
            for t, open_nodes in active.items():
                rng = np.random.default_rng([seed, 1, t, level])
                asked = np.sort(rng.random((len(open_nodes), width)).argsort(1)[:, :places], axis=1)
                plans[t] = shape(forest[t], open_nodes), asked, sizes_of[asked]
            if not plans:
                break
            counted = blocks.mapPartitions(_forest_counts(plans, level, draws if bootstrap else None, seed)).reduceByKey(np.add, max(1, min(parts, len(plans))))
            chosen = counted.map(_forest_choice(plans, weights, least)).collect()
            found, active = dict(chosen), {}
            for t, (total, feature, cut, gain, left) in found.items():
                nodes, opened = forest[t], []
                for i, name in enumerate(np.flatnonzero(plans[t][0].slot < len(total))):
                    node = nodes[name]
                    node.stats, node.count = total[i], total[i].sum()
                    if feature[i] >= 0:
                        node.feature, node.cut, node.gain = int(feature[i]), int(cut[i]), float(gain[i])
                        node.left, node.right = len(nodes), len(nodes) + 1
                        nodes += [Node(left[i].sum(), left[i]), Node(total[i].sum() - left[i].sum(), total[i] - left[i])]
                        opened += [node.left, node.right]
                # A leaf of one class is closed without a scan.
                opened = [k for k in opened if nodes[k].stats.min() > 0]
                if opened:
                    active[t] = opened
        for t in sorted(forest):
            for node in forest[t]:
                node.stats = np.zeros(2) if node.stats is None else node.stats * weights
            prune(forest[t], lambda n: int(n.stats[1] > n.stats[0]))
            out.append(forest[t])
    return out


def _forest_choice(plans, weights, least):
    def choose(found):
        t, flat = found
        _, asked, sizes = plans[t]
        return t, best_of_forest(flat, asked, sizes, weights, least)
    return choose


def _forest_counts(plans, level, draws, seed):
    def run(blocks):
        sums = {}
        for number, x, y in blocks:
            y = np.frombuffer(y, np.uint8)
            x = np.frombuffer(x, np.uint8) * np.uint8(2)  # two classes a bin
            width = len(x) // len(y)
            for t, (tree, asked, _) in plans.items():
                if draws is None:
                    rows, times = np.arange(len(y)), np.ones(len(y))
                else:
                    rng = np.random.default_rng([seed, 0, t, number])
                    drawn = draws[rng.integers(0, 65_536, len(y), np.uint16)]
                    rows = np.flatnonzero(drawn)
                    times = drawn[rows]
                base, node = rows * width, np.zeros(len(rows), np.int64)
                for _ in range(level):
                    right = x.take(base + tree.feature.take(node)) > 2 * tree.cut.take(node)
                    node = tree.child.take(2 * node + right)
                slot = tree.slot.take(node)
                if level:
                    still = np.flatnonzero(slot < len(asked))
                    rows, times, base, slot = rows[still], times[still], base[still], slot[still]
                places, times = asked.shape[1], times.astype(float)
                seen = np.empty((places, len(rows)), np.uint8)
                for i in range(0, len(rows), NEAR):
                    seen[:, i : i + NEAR] = x.take(base[i : i + NEAR, None] + asked.take(slot[i : i + NEAR], axis=0)).T
                if t not in sums:
                    sums[t] = np.zeros((places, len(asked) * BINS * 2))
                first = slot * (2 * BINS) + y[rows]
                for place, got in enumerate(sums[t]):
                    got += np.bincount(first + seen[place], times, minlength=len(got))
        for t, got in sums.items():
            _, asked, sizes = plans[t]
            counts = got.reshape(asked.shape[1], len(asked), BINS, 2).transpose(1, 0, 2, 3)
            yield t, counts[np.arange(BINS) < sizes[..., None]].astype(np.int64).ravel()
    return run


# A boosted ensemble.

class Bundles(NamedTuple):
    """Features counted together: the bundle of each feature, its stride there, and the bins of each feature."""

    bundle: np.ndarray
    stride: np.ndarray
    bins: np.ndarray
    members: list[list[int]]


def bundles_of(bins: Sequence[int], most: int = CELLS) -> Bundles:
    """Features with many bins first, each into the first bundle that has room."""
    bundle, stride = np.zeros(len(bins), np.int64), np.ones(len(bins), np.int64)
    members, cells = [], []
    for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
        b = next((i for i, c in enumerate(cells) if c * bins[f] <= most), None)
        if b is None:
            b = len(cells)
            members.append([])
            cells.append(1)
        bundle[f], stride[f] = b, cells[b]
        members[b].append(f)
        cells[b] *= bins[f]
    return Bundles(bundle, stride, np.asarray(bins), members)


def by_feature(cells: np.ndarray, by: Bundles) -> np.ndarray:
    """Sums ``(node, bin of all features in turn)`` from those by ``(bundle, node, cell)``."""
    out = [None] * len(by.bins)
    code = np.arange(CELLS)[:, None]
    for b, fs in enumerate(by.members):
        holds = np.concatenate([code // by.stride[f] % by.bins[f] == np.arange(by.bins[f]) for f in fs], axis=1).astype(float)
        ends = np.cumsum([by.bins[f] for f in fs])[:-1]
        for f, part in zip(fs, np.split(cells[b] @ holds, ends, axis=1)):
            out[f] = part
    return np.concatenate(out, axis=1)


def _walk(codes: np.ndarray, nodes: Shape, by: Bundles, steps: int) -> np.ndarray:
    """The node that every row reaches; whether a row goes right is looked up by its bundle's code."""
    flat, n = codes.ravel(), codes.shape[1]
    if not steps:
        return np.zeros(n, np.int64)
    code = np.arange(CELLS)
    right = code // by.stride[nodes.feature][:, None] % by.bins[nodes.feature][:, None] > nodes.cut[:, None]
    after = np.where(right, nodes.child[1::2, None], nodes.child[::2, None]).ravel()
    start, row, node = by.bundle[nodes.feature] * n, np.arange(n), np.zeros(n, np.int64)
    for _ in range(steps):
        node = after.take(node * CELLS + flat.take(start.take(node) + row))
    return node


def _residuals(margins: np.ndarray, y: bytes) -> np.ndarray:
    """What the next tree is fitted to: minus the gradient of the log loss at the margins."""
    sign = 2.0 * np.frombuffer(y, np.uint8) - 1.0
    return 4.0 * sign / (1.0 + np.exp(np.clip(2.0 * sign * margins, -700, 700)))


def _boosting_sums(tree: Shape, by: Bundles, level: int, t: int, subsample: float, seed: int, open_nodes: int, powers: int):
    """One array of a part: for each power of the residuals the sums by node and bin, then by node alone."""
    def run(blocks):
        total = np.zeros((powers, len(by.members), open_nodes * CELLS))
        plain = np.zeros((3, open_nodes))
        for number, codes, y, _, residuals in blocks:
            codes = np.frombuffer(codes, np.uint16).reshape(-1, len(y))
            r = np.frombuffer(residuals)
            at = tree.slot.take(_walk(codes, tree, by, level))
            if subsample < 1:
                at[np.random.default_rng([seed, t, number]).random(len(y)) >= subsample] = open_nodes
            weights = [None, r, r * r]
            for p in range(3):
                plain[p] += np.bincount(at, weights[p], minlength=open_nodes + 1)[:open_nodes]
            at = at * CELLS
            for b, column in enumerate(codes):
                cell = at + column
                for p in range(powers):
                    total[p, b] += np.bincount(cell, weights[p], minlength=(open_nodes + 1) * CELLS)[: open_nodes * CELLS]
        bins = [by_feature(x.reshape(-1, open_nodes, CELLS), by).ravel() for x in total]
        yield np.concatenate([*bins, plain.ravel()])
    return run


def _add_up(sums: RDD) -> np.ndarray:
    return sums.reduce(np.add) if sums.getNumPartitions() <= DIRECT else sums.treeReduce(np.add)


def variance(stats: np.ndarray) -> float:
    n, total, squares = stats
    return (squares - total * total / n) / n if n else 0.0


def grow_boosted_tree(state: RDD, by: Bundles, t: int, depth: int, subsample: float, seed: int) -> list[Node]:
    """A regression tree of the residuals, a scan a level."""
    nodes, active = [Node()], [0]
    bins = by.bins
    place = np.repeat(np.arange(len(bins)), bins), np.concatenate([np.arange(b) for b in bins])
    able = np.arange(BINS - 1) < bins[:, None] - 1
    for level in range(depth):
        m, last = len(active), level == depth - 1
        powers = 3 if last else 2
        sums = _add_up(state.mapPartitions(_boosting_sums(shape(nodes, active), by, level, t, subsample, seed, m, powers)))
        plain = sums[-3 * m :].reshape(3, m)
        full = np.zeros((powers, m, len(bins), BINS))
        full[:, :, place[0], place[1]] = sums[: -3 * m].reshape(powers, m, -1)
        low = full.cumsum(3)[..., :-1]
        high = plain[:powers, :, None, None] - low
        n, total = plain[0], plain[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (low[1] ** 2 / low[0] + high[1] ** 2 / high[0] - (total**2 / n)[:, None, None]) / n[:, None, None]
        gain = np.where(able & (low[0] >= 1) & (high[0] >= 1), gain, -1.0).reshape(m, -1)
        best = gain.argmax(1)
        opened = []
        for i, name in enumerate(active):
            node = nodes[name]
            node.count, node.stats = n[i], plain[:, i]
            if gain[i, best[i]] > 0 and abs(variance(node.stats)) >= PURE:
                f, cut = divmod(int(best[i]), BINS - 1)
                node.feature, node.cut, node.gain, node.left, node.right = f, cut, float(gain[i, best[i]]), len(nodes), len(nodes) + 1
                for side in (low, high):
                    nodes.append(Node(side[0, i, f, cut], side[:, i, f, cut] if last else None))
                opened += [node.left, node.right]
        active = opened
        if not active:
            break
    prune(nodes, lambda k: _mean(k))
    return nodes


def _mean(node: Node) -> float:
    return node.stats[1] / node.stats[0] if node.stats is not None and node.stats[0] else 0.0


def _first_state(by: Bundles):
    def run(block):
        number, x, y = block
        n = len(y)
        x = np.frombuffer(x, np.uint8).reshape(n, -1)
        codes = np.zeros((len(by.members), n), np.uint16)
        for f in range(x.shape[1]):
            codes[by.bundle[f]] += x[:, f].astype(np.uint16) * np.uint16(by.stride[f])
        return number, codes.tobytes(), y, np.zeros(n).tobytes(), (2.0 * np.frombuffer(y, np.uint8) - 1.0).tobytes()
    return run


def _advanced(tree: Shape, by: Bundles, values: np.ndarray, depth: int):
    def run(block):
        number, codes, y, margins, _ = block
        reached = _walk(np.frombuffer(codes, np.uint16).reshape(-1, len(y)), tree, by, depth)
        margins = np.frombuffer(margins) + values.take(reached)
        return number, codes, y, margins.tobytes(), _residuals(margins, y).tobytes()
    return run


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def grow_boosted(spark: SparkSession, blocks: RDD, cuts: Sequence[np.ndarray], trees: int, step: float, depth: int, subsample: float,
                 seed: int) -> list[list[Node]]:
    """Trees that follow each other, the first fitted to the labels. The margins of the rows go with the blocks and are written every few trees, so that a lost part
    repeats the steps since then only."""
    shared_folder(spark)
    by = bundles_of([len(c) + 1 for c in cuts])
    kept, out, written = [], [], None
    state = blocks.map(_first_state(by)).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(state)
    for t in range(trees):
        nodes = grow_boosted_tree(state, by, t, depth, subsample, seed)
        out.append(nodes)
        while len(kept) > 1:  # the steps before this one, which are no longer read
            kept.pop(0).unpersist()
        if t + 1 == trees:
            break
        values = np.array([_mean(n) for n in nodes]) * (step if t else 1.0)
        state = state.map(_advanced(shape(nodes, []), by, values, depth)).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(state)
        if (t + 1) % CHECKPOINT == 0:
            state.checkpoint()
            state.count()
            _delete(spark, written)
            written = state.getCheckpointFile()
    for rdd in kept:
        rdd.unpersist()
    _delete(spark, written)
    return out


# Fits.

def stored_rows(trees: Sequence[Sequence[Node]], cuts: Sequence[np.ndarray], forest: bool, first: int = 0) -> Iterator[tuple]:
    """The rows of the library's stored form, trees from number ``first``, nodes numbered from the root, left before right."""
    for t, nodes in enumerate(trees, first):
        order, todo = [], [0]
        while todo:
            name = todo.pop()
            order.append(name)
            if nodes[name].feature >= 0:
                todo += [nodes[name].right, nodes[name].left]
        number = {name: i for i, name in enumerate(order)}
        for name in order:
            node = nodes[name]
            stats = np.zeros(2 if forest else 3) if node.stats is None else node.stats
            w = float(stats.sum())
            impurity = (1.0 - float((stats * stats).sum()) / (w * w) if w else 0.0) if forest else float(variance(stats))
            prediction = float(stats[1] > stats[0]) if forest else float(_mean(node))
            split = (node.feature, [float(cuts[node.feature][node.cut])], -1) if node.feature >= 0 else (-1, [], -1)
            yield t, (number[name], prediction, impurity, [float(v) for v in stats], int(node.count), float(node.gain),
                      number.get(node.left, -1), number.get(node.right, -1), split)


def as_model(spark: SparkSession, estimator, trees: Sequence[Sequence[Node]], cuts: Sequence[np.ndarray]):
    """A model of the library with these trees: its own stored form of a fit to two rows, with other nodes."""
    forest = isinstance(estimator, RandomForestClassifier)
    many = "numTrees" if forest else "maxIter"
    columns = [estimator.getLabelCol(), "features"] + ([estimator.getWeightCol()] if estimator.isSet("weightCol") else [])
    few = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2)] * len(cuts)), 1.0)[: len(columns)] for i in range(4)], columns)
    first, path = work_path(spark, "one-tree"), work_path(spark, "grown")
    estimator.copy({estimator.getParam(many): 1}).fit(few).write().save(first)
    about = json.loads(spark.read.text(f"{first}/metadata").first()[0])
    about["numTrees"] = about["paramMap"][many] = len(trees)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    old = spark.read.parquet(f"{first}/treesMetadata")
    one = old.first()
    factor = 1.0 if forest else estimator.getStepSize()
    spark.createDataFrame([(t, one[1], factor if t else 1.0) for t in range(len(trees))], old.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    names = spark.read.parquet(f"{first}/data").columns
    for start in range(0, len(trees), GROUP):
        some = list(stored_rows(trees[start : start + GROUP], cuts, forest, start))
        spark.createDataFrame(some, STORED, verifySchema=False).toDF(*names).coalesce(1).write.mode("append").parquet(f"{path}/data")
    model = (RandomForestClassificationModel if forest else GBTClassificationModel).load(path)
    _delete(spark, first)
    return model


def _packed(rows: DataFrame, class_weights: Sequence[float], seed: int) -> tuple[list[np.ndarray], RDD]:
    cuts = find_cuts(rows, rows.count(), class_weights, seed)
    return cuts, binned(rows, cuts).persist(StorageLevel.MEMORY_AND_DISK)


def fit_forest(rows: DataFrame, estimator: RandomForestClassifier, class_weights: Sequence[float]):
    """The estimator's forest on ``rows(x array<double>, y double)`` of two classes, 0 and 1, by scans."""
    cuts, blocks = _packed(rows, class_weights, estimator.getSeed())
    trees = grow_forest(blocks, cuts, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), class_weights, estimator.getSeed())
    blocks.unpersist()
    return as_model(rows.sparkSession, estimator, trees, cuts)


def fit_boosting(rows: DataFrame, estimator: GBTClassifier):
    """The estimator's boosted trees on the same kind of rows."""
    spark = rows.sparkSession
    cuts, blocks = _packed(rows, (1.0, 1.0), estimator.getSeed())
    trees = grow_boosted(spark, blocks, cuts, estimator.getMaxIter(), estimator.getStepSize(), estimator.getMaxDepth(), estimator.getSubsamplingRate(), estimator.getSeed())
    blocks.unpersist()
    return as_model(spark, estimator, trees, cuts)
