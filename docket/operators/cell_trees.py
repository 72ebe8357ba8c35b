"""Boosted trees grown from counted cells, the same that Spark's own learner grows from rows.

A tree learner sees a row through its bins alone. Rows alike in all bins, label and weight are one cell, and a
pass over the cells adds up what a pass over the rows would: there are never more cells than rows, and never more than the bins allow.
Thresholds, splits, stops and pruning are those of Spark's learner. Rows are drawn one by one from the same random numbers
before they are added up, so the trees are those that ``GBTClassifier`` fits, to rounding, and what is returned is its model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from docket.operators.java_draws import JavaRandom, RowDraws, XorShift
from docket.session import by_key, scratch_path, ship, staged

#: So many draws of cells are kept by the driver; beyond them the cells stay in files and each level is a job.
KEPT_DRAWS = 1 << 25
#: Trees drawn in one pass over the rows: with few cells, and with many.
TREES_A_PASS, TREES_A_LONG_PASS = 128, 16

#: Gains that differ by less than this share of the node's impurity are alike.
TIE = 1e-12


@dataclass(frozen=True)
class Layout:
    """How the features are binned: the values of a nominal one (0 for numbers) and the thresholds of a numeric one."""

    sizes: list[int]
    thresholds: list[np.ndarray]

    @property
    def bins(self) -> np.ndarray:
        return np.array([size or len(cuts) + 1 for size, cuts in zip(self.sizes, self.thresholds)])

    @property
    def starts(self) -> np.ndarray:
        """Where the bins of each feature begin when all are put one after another."""
        return np.concatenate([[0], np.cumsum(self.bins)[:-1]]).astype(np.int64)

    def codes(self, x: np.ndarray) -> np.ndarray:
        columns = [x[:, f] if size else np.searchsorted(cuts, x[:, f]) for f, (size, cuts) in enumerate(zip(self.sizes, self.thresholds))]
        return np.stack(columns, 1).astype(np.uint16)


def nominal_sizes(rows: DataFrame) -> list[int]:
    """The values of each feature of the vector by its metadata, 0 for numbers."""
    about = rows.schema["features"].metadata["ml_attr"]
    sizes = [0] * about["num_attrs"]
    for a in about["attrs"].get("nominal", []):
        sizes[a["idx"]] = len(a["vals"])
    for a in about["attrs"].get("binary", []):
        sizes[a["idx"]] = 2
    return sizes


def split_points(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Thresholds of a feature from a sample: between all values, or nearest to even shares of the expected weight."""
    known = values != 0.0
    found, place = np.unique(values[known], return_inverse=True)
    if not len(found):
        return np.zeros(0)
    weight = np.bincount(place, weights[known])
    # Zeros, and what the sample lacks of the weight expected, count as zeros.
    if expected - weight.sum() > np.finfo(float).eps * known.sum() * 100:
        at = np.searchsorted(found, 0.0)
        found, weight = np.insert(found, at, 0.0), np.insert(weight, at, expected - weight.sum())
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = target = expected / (most + 1)
    passed, kept = np.cumsum(weight), []
    for i, cut in enumerate(middle):
        if abs(passed[i] - target) < abs(passed[i + 1] - target):
            kept.append(cut)
            target += stride
    return np.array(kept)


def layout_of(dealt: DataFrame, max_bins: int, seed: int) -> Layout:
    """The bins that Spark's learners make of dealt rows: thresholds come from the same sample."""
    rows, weight = dealt.agg(F.count("*"), F.sum("weight")).first()
    sizes, most = nominal_sizes(dealt), min(max_bins, rows)
    if not rows or most < max(sizes) or most >= 1 << 16:
        raise ValueError(f"{rows} rows, {max(sizes)} values of a feature and {most} bins do not make a tree")
    cuts = [np.zeros(0)] * len(sizes)
    numeric = [f for f, size in enumerate(sizes) if not size]
    if numeric:
        wanted, taken = max(most * most, 10_000), dealt.select("weight", "features")
        share = wanted / rows if wanted < rows else 1.0
        if share < 1.0:
            sample = taken._jdf.toJavaRDD().sample(False, share, XorShift(seed).next_int())
            taken = DataFrame(taken.sparkSession._jsparkSession.createDataFrame(sample, taken._jdf.schema()), taken.sparkSession)
        table = taken.select("weight", vector_to_array("features").alias("x")).toArrow()
        x = table["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(sizes))
        for f in numeric:
            cuts[f] = split_points(x[:, f], table["weight"].to_numpy(), share * weight, most - 1)
    return Layout(sizes, cuts)


# A cell is the text of its codes, label and weight, as bytes.


def _packed(a: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    a = np.ascontiguousarray(a)
    ends = np.arange(len(a) + 1, dtype=np.int32) * (a.shape[1] * a.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends), pa.py_buffer(a)])


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        parts = [_unpacked(c, kind, width) for c in column.chunks]
        return np.concatenate(parts) if parts else np.zeros((0, width), kind)
    if not len(column):
        return np.zeros((0, width), kind)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8)[first : first + len(column) * width * np.dtype(kind).itemsize].view(kind).reshape(-1, width)


def _summed(cells: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like cells once, with the sums of their rows."""
    if not len(cells):
        return cells, sums
    order = np.lexsort(cells.T[::-1])
    cells = cells[order]
    first = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]).any(1)]))
    return cells[first], np.add.reduceat(sums[order], first, axis=0, dtype=sums.dtype)


@dataclass
class Cells:
    """The parts of a batch of cells: codes ``[feature, cell]``, label, weight."""

    x: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, cells: np.ndarray, layout: Layout) -> Cells:
        p = len(layout.sizes)
        x = np.ascontiguousarray(cells[:, :p].T)
        return cls(x, cells[:, p].astype(np.int64), np.ascontiguousarray(cells[:, p + 1 :]).view(np.float64).ravel())


def cells_of(rows: DataFrame, layout: Layout) -> DataFrame:
    """One column ``cell`` for rows ``(label, weight, features)``, in their partitions and order."""
    ship(rows.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if n := batch.num_rows:
                x = layout.codes(batch.column(2).flatten().to_numpy().reshape(n, -1))
                label = batch.column(0).to_numpy().astype(np.uint16)[:, None]
                weight = np.array(batch.column(1).to_numpy(), dtype=np.float64).view(np.uint16).reshape(n, 4)
                yield pa.RecordBatch.from_arrays([_packed(np.concatenate([x, label, weight], 1))], ["cell"])

    plain = rows.select(F.col("label").cast("int"), "weight", vector_to_array("features").alias("x"))
    return plain.mapInArrow(code, "cell binary")


def counted_cells(cells: DataFrame) -> DataFrame:
    """Rows ``(cell, n)``; like rows of a batch are counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                width = len(batch.column(0)[0].as_py()) // 2
                found, n = _summed(_unpacked(batch.column(0), np.uint16, width), np.ones(batch.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([_packed(found), pa.array(n)], ["cell", "n"])

    return cells.mapInArrow(count, "cell binary, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


# One tree


@dataclass
class Node:
    stats: np.ndarray
    impurity: float
    said: float
    gain: float = -1.0
    split: tuple = (-1, [], -1)
    children: tuple = ()

    def pruned(self) -> Node:
        """The node without splits whose two leaves say the same."""
        if not self.children:
            return self
        left, right = (c.pruned() for c in self.children)
        if not left.children and not right.children and left.said == right.said:
            return Node(self.stats, self.impurity, self.said)
        return Node(self.stats, self.impurity, self.said, self.gain, self.split, (left, right))


@dataclass
class Step:
    """A level of a tree: what each open node tests, who goes left, and where the sides lead: a slot of the next level, or -1 - leaf."""

    feature: np.ndarray
    left: np.ndarray
    child: np.ndarray

    def move(self, x: np.ndarray, slot: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(slot >= 0)
        s, out = slot[at], slot.copy()
        out[at] = np.where(self.left[s, x[self.feature[s], at]], self.child[s, 0], self.child[s, 1])
        return out


# Sums are weight, weighted label, weighted squared label, and rows.
WIDTH = 4


def _impurity(s: np.ndarray) -> np.ndarray:
    """The variance of the label."""
    n = np.where(s[..., 0] != 0, s[..., 0], 1.0)
    return np.where(s[..., 0] != 0, (s[..., 2] - s[..., 1] * s[..., 1] / n) / n, 0.0)


def _mean(s: np.ndarray) -> np.ndarray:
    return s[..., 1] / np.where(s[..., 0] != 0, s[..., 0], 1.0)


class Tree:
    """A tree that grows level by level from the sums of its open nodes by bin."""

    def __init__(self, layout: Layout, depth: int, least: int = 1, min_gain: float = 0.0, tries: Callable | None = None):
        self.layout, self.depth, self.least, self.min_gain, self.tries = layout, depth, least, min_gain, tries
        self.steps: list[Step] = []
        self.values: list[float] = []
        self.root: Node | None = None
        self.open: list[Node | None] = [None]

    def __getstate__(self) -> dict:
        """What a task needs to pass cells down the tree."""
        return self.__dict__ | {"root": None, "tries": None, "open": [None] * len(self.open)}

    def slots(self, x: np.ndarray) -> np.ndarray:
        """The open node that every row of codes has reached, or -1 - leaf."""
        slot = np.zeros(x.shape[1], np.int64)
        for step in self.steps:
            slot = step.move(x, slot)
        return slot

    def predictions(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.values)[-1 - self.slots(x)]

    def sums(self, cells: Cells, slot: np.ndarray, parts: Sequence[np.ndarray]) -> np.ndarray:
        """Sums ``[node, bin of all features, part]`` of the cells in open nodes."""
        nodes, out = len(self.open), np.empty((len(self.open), int(self.layout.bins.sum()), len(parts)))
        # Cells in leaves go to a node of their own, which is left out.
        node = np.where(slot >= 0, slot, nodes)
        for codes, first, bins in zip(cells.x, self.layout.starts, self.layout.bins):
            at = node * bins + codes
            for k, part in enumerate(parts):
                out[:, first : first + bins, k] = np.bincount(at, part, (nodes + 1) * bins).reshape(nodes + 1, bins)[:nodes]
        return out

    def split(self, sums: np.ndarray) -> None:
        """Split each open node where it gains most; children that may not split are leaves."""
        layout, nodes = self.layout, len(self.open)
        tried = [self.tries() if self.tries else range(len(layout.sizes)) for _ in range(nodes)]
        found = {}
        for f, (first, bins) in enumerate(zip(layout.starts, layout.bins)):
            if bins < 2:
                continue
            s, order = sums[:, first : first + bins], np.tile(np.arange(bins), (nodes, 1))
            if layout.sizes[f]:
                order = np.argsort(np.where(s[..., 0] != 0, _mean(s), np.inf), axis=1, kind="stable")
                s = np.take_along_axis(s, order[:, :, None], 1)
            s = np.cumsum(s, 1)
            left, whole = s[:, :-1], s[:, -1:]
            right = whole - left
            n, nl, nr = whole[..., 0], left[..., 0], right[..., 0]
            impurity = _impurity(whole)
            gain = impurity - nl / np.where(n > 0, n, 1.0) * _impurity(left) - nr / np.where(n > 0, n, 1.0) * _impurity(right)
            valid = (left[..., 3] >= self.least) & (right[..., 3] >= self.least) & (gain >= self.min_gain)
            gain = np.where(valid, gain, -np.inf)
            best = gain.argmax(1)
            found[f] = (gain[np.arange(nodes), best], best, order, left, right, whole, impurity)
        step = Step(np.zeros(nodes, np.int64), np.zeros((nodes, int(layout.bins.max())), bool), np.zeros((nodes, 2), np.int64))
        opened: list[Node | None] = []
        for i, node in enumerate(self.open):
            if node is None:
                whole = sums[i, : layout.bins[0]].sum(0)
                node = self.root = Node(whole, float(_impurity(whole)), float(_mean(whole)))
            choices = [f for f in tried[i] if f in found]
            # Features that part the rows alike gain alike but for rounding: the first of them is taken, however the sums were added up.
            top = max((found[f][0][i] for f in choices), default=-np.inf)
            f = next((f for f in choices if found[f][0][i] >= top - TIE * abs(found[f][6][i, 0])), None)
            if f is None or not found[f][0][i] > 0:
                if f is None or found[f][0][i] == -np.inf:
                    node.impurity = -1.0
                self.values.append(node.said)
                step.child[i] = -len(self.values)
                continue
            gain, best, order, left, right, _, impurity = found[f]
            k = best[i]
            taken = order[i, : k + 1]
            step.feature[i], step.left[i, taken] = f, True
            if layout.sizes[f]:
                node.split = (f, [float(c) for c in np.sort(taken)], layout.sizes[f])
            else:
                node.split = (f, [float(layout.thresholds[f][k])], -1)
            node.gain = float(gain[i])
            node.children = tuple(Node(s, float(_impurity(s)), float(_mean(s))) for s in (left[i, k], right[i, k]))
            for side, child in enumerate(node.children):
                if len(self.steps) + 1 == self.depth or abs(child.impurity) < np.finfo(float).eps:
                    self.values.append(child.said)
                    step.child[i, side] = -len(self.values)
                else:
                    step.child[i, side] = len(opened)
                    opened.append(child)
        # Spark takes the nodes of a level from a stack, so the last one is the first to draw the features that it tries.
        step.child = np.where(step.child >= 0, len(opened) - 1 - step.child, step.child)
        self.steps.append(step)
        self.open = opened[::-1]

    def rows(self, number: int) -> list[tuple]:
        """The nodes as a saved Spark model has them, numbered in the order of their paths."""
        out: list[list] = []

        def put(node: Node) -> int:
            at = len(out)
            out.append([at, node.said, node.impurity, [float(v) for v in node.stats[:3]], int(node.stats[3]), node.gain, -1, -1, node.split])
            for side, child in enumerate(node.children):
                out[at][6 + side] = put(child)
            return at

        put(self.root.pruned())
        return [(number, tuple(r)) for r in out]


# Boosted trees


def _residuals(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree learns: the labels at first, then minus the gradient of the logistic loss."""
    with np.errstate(over="ignore"):
        return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _margin(trees: Sequence[Tree], rates: Sequence[float], x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray | None:
    for tree, rate in zip(trees, rates):
        more = tree.predictions(x) * rate
        start = more if start is None else start + more
    return start


def drawn_rows(cells: DataFrame, rate: float, seeds: Sequence[int], width: int) -> DataFrame:
    """Rows ``(cell, draws)``, like cells once: how many of a cell's rows each tree draws, the rows dealt and drawn as Spark does."""

    def emit(found: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([_packed(found[i : i + 10_000]), _packed(sums[i : i + 10_000])], ["cell", "draws"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        draws = RowDraws([seed + place + 1 for seed in seeds], rate)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            if batch.num_rows:
                own = draws.take(batch.num_rows).astype(np.int32)
                kept.append(_summed(_unpacked(batch.column(0), np.uint16, width), own))
                held += kept[-1][1].size
            if held > 1 << 24:
                merged = _summed(*(np.concatenate(part) for part in zip(*kept)))
                kept, held = [merged], merged[1].size
                if held > 1 << 23:
                    yield from emit(*merged)
                    kept, held = [], 0
        if kept:
            yield from emit(*_summed(*(np.concatenate(part) for part in zip(*kept))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows:
                found, sums = _unpacked(batch.column(0), np.uint16, width), _unpacked(batch.column(1), np.int32, len(seeds))
                if last is not None:
                    found, sums = np.concatenate([last[0], found]), np.concatenate([last[1], sums])
                found, sums = _summed(found, sums)
                # Rows come in the order of the cell's bytes: the last cell may go on in the next batch.
                own = (found == _unpacked(batch.column(0), np.uint16, width)[-1]).all(1)
                last = found[own], sums[own]
                yield from emit(found[~own], sums[~own])
        if last is not None:
            yield from emit(*last)

    schema = "cell binary, draws binary"
    partial = cells.mapInArrow(draw, schema)
    return partial.repartition("cell").sortWithinPartitions("cell").mapInArrow(merge, schema)


class Boosting:
    """The boosted trees of one learner; cells lie with the driver if their draws are few, else in files."""

    def __init__(self, learner: GBTClassifier, dealt: DataFrame, kept_draws: int):
        get = lambda name: learner.getOrDefault(name)
        self.seed, self.rate, self.trees = get("seed"), get("subsamplingRate"), get("maxIter")
        self.layout = layout_of(dealt, get("maxBins"), self.seed)
        self.width = len(self.layout.sizes) + 5
        self.depth, self.least, self.min_gain, self.subset = get("maxDepth"), get("minInstancesPerNode"), get("minInfoGain"), get("featureSubsetStrategy")
        self.rates = [1.0] + [get("stepSize")] * (self.trees - 1)
        self.grown: list[Tree] = []
        cells = cells_of(dealt, self.layout).persist()
        try:
            n = counted_cells(cells).count()
            few = n * min(self.trees, TREES_A_PASS) <= kept_draws
            size = TREES_A_PASS if few else TREES_A_LONG_PASS
            for first in range(0, self.trees, size):
                block = range(first, min(first + size, self.trees))
                (self._near if few else self._far)(self._drawn(cells, block), block)
        finally:
            cells.unpersist()

    def _drawn(self, cells: DataFrame, block: range) -> DataFrame:
        if self.rate < 1.0:
            return drawn_rows(cells, self.rate, [self.seed + m for m in block], self.width)
        return drawn_rows(cells, 1.0, [self.seed], self.width)

    def _new(self, m: int) -> Tree:
        p = len(self.layout.sizes)
        k = features_tried(self.subset, p)
        tries = None
        if k < p:
            random = JavaRandom(self.seed + m)
            tries = lambda: reservoir(p, k, random.next_long())
        return Tree(self.layout, self.depth, self.least, self.min_gain, tries)

    def _near(self, drawn: DataFrame, block: range) -> None:
        table = drawn.toArrow()
        found, draws = _unpacked(table["cell"], np.uint16, self.width), _unpacked(table["draws"], np.int32, len(block) if self.rate < 1.0 else 1)
        order = np.lexsort(found.T[::-1])
        cells, draws = Cells.of(found[order], self.layout), np.asfortranarray(draws[order])
        y = 2.0 * cells.label - 1.0
        margin = _margin(self.grown, self.rates, cells.x)
        for m in block:
            times = draws[:, (m - block[0]) if self.rate < 1.0 else 0].astype(float)
            tree, slot = self._new(m), np.zeros(len(y), np.int64)
            parts = _variance_parts(times, cells.weight, _residuals(y, margin))
            while tree.open:
                tree.split(tree.sums(cells, slot, parts))
                slot = tree.steps[-1].move(cells.x, slot)
            more = np.array(tree.values)[-1 - slot] * self.rates[m]
            margin = more if margin is None else margin + more
            self.grown.append(tree)

    def _far(self, drawn: DataFrame, block: range) -> None:
        layout, width, columns = self.layout, self.width, len(block) if self.rate < 1.0 else 1
        before, rates, every = list(self.grown), self.rates, self.rate < 1.0
        ship(drawn.sparkSession)

        def with_margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = Cells.of(_unpacked(batch.column(0), np.uint16, width), layout).x
                    margin = _margin(before, rates, x) if before else np.zeros(batch.num_rows)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], ["cell", "draws", "margin"])

        kept = staged(drawn.mapInArrow(with_margin, "cell binary, draws binary, margin double"), "drawn")
        for m in block:
            tree, since, rate = self._new(m), self.grown[block[0] :], rates[block[0] : m]
            while tree.open:

                def level(batches: Iterator[pa.RecordBatch], tree=tree, since=since, rate=rate, m=m) -> Iterator[pa.RecordBatch]:
                    total = np.zeros((len(tree.open), int(layout.bins.sum()), WIDTH))
                    for batch in batches:
                        if batch.num_rows:
                            cells = Cells.of(_unpacked(batch.column(0), np.uint16, width), layout)
                            times = _unpacked(batch.column(1), np.int32, columns)[:, (m - block[0]) if every else 0].astype(float)
                            margin = None if m == 0 else _margin(since, rate, cells.x, batch.column(2).to_numpy() if before else None)
                            parts = _variance_parts(times, cells.weight, _residuals(2.0 * cells.label - 1.0, margin))
                            total += tree.sums(cells, tree.slots(cells.x), parts)
                    yield pa.RecordBatch.from_arrays([_packed(total.reshape(1, -1))], ["sums"])

                rows = kept.mapInArrow(level, "sums binary").collect()
                shape = (len(tree.open), int(layout.bins.sum()), WIDTH)
                tree.split(sum(np.frombuffer(r["sums"]).reshape(shape) for r in rows))
            self.grown.append(tree)


def _variance_parts(times: np.ndarray, weight: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    w = times * weight
    return [w, w * label, w * label * label, times]


def features_tried(subset: str, features: int) -> int:
    """How many features a node of a lone tree tries, by the name, number or share of a subset."""
    if subset in ("auto", "all"):
        return features
    if subset in ("sqrt", "log2", "onethird"):
        return {"sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3.0)}[subset]
    return min(features, int(subset)) if subset.isdigit() else math.ceil(float(subset) * features)


def reservoir(features: int, k: int, seed: int) -> list[int]:
    """Spark's sample of the features that a node tries."""
    kept, draw = list(range(k)), XorShift(seed)
    for i in range(k, features):
        place = int(draw.next_double() * (i + 1))
        if place < k:
            kept[place] = i
    return kept


# Saved as Spark saves them


_TREE_DEFAULTS = ("cacheNodeIds", "checkpointInterval", "featuresCol", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")

_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _model(learner: GBTClassifier, trees: Sequence[Tree], weights: Sequence[float], features: int, spark) -> GBTClassificationModel:
    """The trees as the learner's fitted model."""
    params = {p.name: v for p, v in learner._paramMap.items()}
    defaults = {p.name: v for p, v in learner._defaultParamMap.items()}
    about = {"timestamp": 0, "sparkVersion": spark.version}
    top = {"class": "org.apache.spark.ml.classification.GBTClassificationModel", **about, "uid": learner.uid}
    top |= {"paramMap": params, "defaultParamMap": defaults, "numFeatures": features, "numTrees": len(trees)}
    of_tree = {k: defaults[k] for k in _TREE_DEFAULTS if k in defaults} | {"impurity": "variance"}
    one = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", **about}
    one |= {"paramMap": {k: v for k, v in params.items() if k in of_tree}, "defaultParamMap": of_tree}
    path = scratch_path(spark, "model")
    spark.createDataFrame([(json.dumps(top),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    listed = [(i, json.dumps(one | {"uid": f"dtr_{learner.uid}_{i}"}), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([r for i, t in enumerate(trees) for r in t.rows(i)], _NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_boosted(learner: GBTClassifier, rows: DataFrame, n: int, kept_draws: int = KEPT_DRAWS) -> GBTClassificationModel:
    """What ``learner.fit(by_key(rows, n, "key"))`` fits, grown from cells."""
    boosting = Boosting(learner, by_key(rows, n, "key"), kept_draws)
    return _model(learner, boosting.grown, boosting.rates, len(boosting.layout.sizes), rows.sparkSession)
