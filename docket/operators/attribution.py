"""Exact Shapley attributions of tree ensembles, computed where the rows are.

A saved tree model is a table of nodes. Its size depends on the model's
parameters and not on the data, so the paths of its leaves go to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from docket import constants as C
from docket.operators.contingency import class_counts, long_values
from docket.operators.lookup import BROADCAST_ROWS, HOT_VALUES
from docket.session import scratch_path, ship, staged


@dataclass(frozen=True)
class Condition:
    """All tests one path makes on one feature, and the share of rows that pass them."""

    feature: int
    low: float
    high: float
    allowed: frozenset | None
    cover: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        ok = (values > self.low) & (values <= self.high)
        if self.allowed is not None:
            ok &= np.isin(values, list(self.allowed))
        return ok


@dataclass(frozen=True)
class Leaf:
    """A leaf's value on the margin scale and the conditions that lead to it."""

    value: float
    conditions: tuple[Condition, ...]


def tree_leaves(spark: SparkSession, stage: Model) -> tuple[list[Leaf], str]:
    """Leaves of a fitted Spark GBT or forest model, and the scale of their sum.

    Boosted trees sum to log-odds, which is twice Spark's raw score; a forest's
    shares sum to the probability of class 1. Covers are the training weights that
    reach a node, so rows repeated by oversampling count as often as they repeat.
    """
    path = scratch_path(spark, "trees")
    stage.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        "nodeData.impurityStats",
        "nodeData.leftChild",
        "nodeData.rightChild",
        "nodeData.split",
    )
    boosted = isinstance(stage, GBTClassificationModel)
    weights = stage.treeWeights
    trees: dict[int, dict[int, object]] = {}
    for r in nodes.collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    cover = lambda node: node["impurityStats"][0] if boosted else sum(node["impurityStats"])
    leaves: list[Leaf] = []
    for tree_id, tree in trees.items():
        factor = 2.0 * weights[tree_id] if boosted else 1.0 / len(trees)
        stack = [(tree[0], {})]
        while stack:
            node, tests = stack.pop()
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                own = node["prediction"] if boosted else stats[1] / sum(stats)
                leaves.append(Leaf(factor * own, tuple(tests.values())))
                continue
            split, sides = node["split"], (tree[node["leftChild"]], tree[node["rightChild"]])
            for side, child in enumerate(sides):
                share = cover(child) / cover(node)
                old = tests.get(split["featureIndex"]) or Condition(
                    split["featureIndex"], -math.inf, math.inf, None, 1.0
                )
                stack.append((child, {**tests, split["featureIndex"]: _narrowed(old, split, side, share)}))
    return leaves, "log_odds" if boosted else "probability"


def _narrowed(old: Condition, split, side: int, share: float) -> Condition:
    low, high, allowed = old.low, old.high, old.allowed
    values, size = split["leftCategoriesOrThreshold"], split["numCategories"]
    if size < 0:
        low, high = (low, min(high, values[0])) if side == 0 else (max(low, values[0]), high)
    else:
        chosen = frozenset(values) if side == 0 else frozenset(float(i) for i in range(size)) - frozenset(values)
        allowed = chosen if allowed is None else allowed & chosen
    return Condition(old.feature, low, high, allowed, old.cover * share)


def pattern_parts(covers: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """Shapley parts of leaves of value 1 for patterns of passed tests.

    ``covers`` has the shape ``(leaves, d)``, ``passed`` the shape ``(patterns, d)`` with 0 and 1; the result
    ``(leaves, patterns, d)``. For one leaf, a subset of its features passes with the product of the pattern's
    tests inside the subset and of the covers outside. Multiplying out one polynomial in the subset
    size weighs all subsets at once.
    """
    n, d = covers.shape
    out = np.empty((n, len(passed), d))
    weights = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
    for i in range(d):
        sizes = np.zeros((n, len(passed), d))
        sizes[:, :, 0] = 1.0
        for j in range(d):
            if j != i:
                grown = sizes * covers[:, j, None, None]
                grown[:, :, 1:] += sizes[:, :, :-1] * passed[None, :, j, None]
                sizes = grown
        out[:, :, i] = (passed[None, :, i] - covers[:, i, None]) * (sizes @ weights)
    return out


class Explainer:
    """Shapley values of rows under a tree model, by tables of pass patterns.

    A row's part in a leaf depends on which of the leaf's tests it passes and on nothing else. For leaves of
    up to ``TABLE_TESTS`` tests the parts of all patterns are worked out once; a row looks its pattern up, so a
    leaf costs a row as many steps as it has tests. Longer leaves work out the patterns that a batch has.
    A feature's values are coded once a batch by the tests that they pass, so a test is a look-up of the code. Rows of
    the same codes are one cell; a cell is worked out once, and up to ``KEPT_CELLS`` cells are kept for the batches that follow.
    """

    TABLE_TESTS = 6
    KEPT_CELLS = 1 << 17

    def __init__(self, leaves: Sequence[Leaf]):
        by_tests: dict[int, list[Leaf]] = {}
        points: dict[int, set[float]] = {}
        for leaf in leaves:
            if leaf.conditions:
                by_tests.setdefault(len(leaf.conditions), []).append(leaf)
            for c in leaf.conditions:
                points.setdefault(c.feature, {-math.inf}).update((c.low, c.high), c.allowed or ())
        self.points = {f: np.array(sorted(p)) for f, p in points.items()}
        # One value for each code: just below a point, the point, above all points, and not a number.
        standing = {
            f: np.append(np.stack([np.nextafter(p, -np.inf), p], 1).ravel(), [np.nextafter(p[-1], np.inf), np.nan])
            for f, p in self.points.items()
        }
        found: dict[int, dict[Condition, np.ndarray]] = {f: {} for f in points}
        for c in {c for group in by_tests.values() for leaf in group for c in leaf.conditions}:
            found[c.feature][c] = c.holds(standing[c.feature])
        # Values that pass the same tests share a code.
        self.codes: dict[int, np.ndarray] = {}
        passes: dict[Condition, np.ndarray] = {}
        for f, by_test in found.items():
            alike, self.codes[f] = np.unique(np.stack(list(by_test.values())), axis=1, return_inverse=True)
            passes |= zip(by_test, alike)
        self.sizes = {f: int(code.max()) + 1 for f, code in self.codes.items()}
        self.packed = math.prod(self.sizes.values()) < 1 << 62
        self.forget()
        self.leaves: list[tuple[Leaf, np.ndarray, np.ndarray, np.ndarray | None, list[np.ndarray]]] = []
        for d, group in sorted(by_tests.items()):
            covers = np.array([[c.cover for c in leaf.conditions] for leaf in group])
            features = np.array([[c.feature for c in leaf.conditions] for leaf in group])
            tables: Sequence = [None] * len(group)
            if d <= self.TABLE_TESTS:
                values = np.array([leaf.value for leaf in group])[:, None, None]
                # One row for each test, over the patterns.
                tables = np.ascontiguousarray((values * pattern_parts(covers, self._bits(np.arange(1 << d), d))).transpose(0, 2, 1))
            kind = np.uint8 if d <= 8 else np.int64
            tests = []
            for leaf in group:
                tests.append([passes[c].astype(kind) << kind(k) for k, c in enumerate(leaf.conditions)])
            self.leaves += zip(group, features, covers, tables, tests)

    @staticmethod
    def _bits(patterns: np.ndarray, d: int) -> np.ndarray:
        return (patterns[:, None] >> np.arange(d) & 1).astype(float)

    def forget(self) -> None:
        """Drop the cells that are kept."""
        self.cells, self.parts = np.zeros(0, np.int64), None

    def _codes(self, feature: int, values: np.ndarray) -> np.ndarray:
        points = self.points[feature]
        place = np.searchsorted(points, values)
        code = 2 * place + (points[np.minimum(place, len(points) - 1)] == values)
        return self.codes[feature][np.where(np.isnan(values), 2 * len(points) + 1, code)]

    def _parts(self, codes: dict[int, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        # Features as rows: a leaf reads and adds to a few of them.
        out = np.zeros(shape[::-1])
        for leaf, features, covers, table, tests in self.leaves:
            pattern = tests[0].take(codes[features[0]])
            for test, feature in zip(tests[1:], features[1:]):
                pattern |= test.take(codes[feature])
            if table is None:
                seen, pattern = np.unique(pattern, return_inverse=True)
                table = leaf.value * pattern_parts(covers[None, :], self._bits(seen.astype(np.int64), len(features)))[0].T
            for part, feature in zip(table, features):
                out[feature] += part.take(pattern)
        return np.ascontiguousarray(out.T)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Shapley value of every feature for every row of ``x``."""
        codes = {f: self._codes(f, x[:, f]) for f in self.points}
        if not self.packed or not codes or not len(x):
            return self._parts(codes, x.shape)
        cell = np.zeros(len(x), np.int64)
        for f, code in codes.items():
            cell = cell * self.sizes[f] + code
        cells, first, inverse = np.unique(cell, return_index=True, return_inverse=True)
        new = ~np.isin(cells, self.cells, assume_unique=True)
        if self.parts is None or len(self.cells) + int(new.sum()) > self.KEPT_CELLS:
            self.forget()
            self.parts, new = np.zeros((0, x.shape[1])), np.ones(len(cells), bool)
        if new.any():
            at = first[new]
            self.cells = np.concatenate([self.cells, cells[new]])
            self.parts = np.concatenate([self.parts, self._parts({f: code[at] for f, code in codes.items()}, (len(at), x.shape[1]))])
            order = np.argsort(self.cells)
            self.cells, self.parts = self.cells[order], self.parts[order]
        return self.parts[np.searchsorted(self.cells, cells)[inverse]]


def leaf_attributions(leaves: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley value of every feature for every row of ``x``."""
    return Explainer(leaves)(x)


def base_value(leaves: Sequence[Leaf]) -> float:
    """The margin expected before any feature is known."""
    return sum(leaf.value * math.prod(c.cover for c in leaf.conditions) for leaf in leaves)


def log_odds_attributions(
    df: DataFrame, columns: Sequence[str], key: str = C.KEY, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows ``(key, feature, value, contribution)`` from add-one class shares of each value.

    A model-free attribution: the contribution of a value is the log of its share in
    class 1 over its share in class 0. ``df`` carries ``label``. The table of values is
    broadcast once its rows have been counted and are few. Otherwise only values of at most one
    thousandth of the rows are joined by a shuffle; the others, at most a thousand of a feature, are broadcast.
    """
    counts = staged(class_counts(df, columns), "class-counts")
    # One row for each feature, whatever its values: a unique column does not meet in one task.
    totals = counts.groupBy("feature").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count("*").alias("values"))
    share = lambda n, t: F.log((F.col(n) + 1.0) / (F.col(t) + F.col("values")))
    odds = counts.join(F.broadcast(totals), "feature").select(
        F.col("feature").alias("f"),
        F.col("value").alias("v"),
        (share("n1", "t1") - share("n0", "t0")).alias("contribution"),
        (F.col("n0") + F.col("n1") > (F.col("t0") + F.col("t1")) / HOT_VALUES).alias("hot"),
    )
    found = staged(odds, "odds")
    cells = long_values(df, columns, [key])
    alike = (F.col("feature") == F.col("f")) & F.col("value").eqNullSafe(F.col("v"))
    if found.count() <= broadcast_rows:
        joined = cells.join(F.broadcast(found), alike)
    else:
        hot, cold = F.broadcast(found.filter("hot")), found.filter(~F.col("hot"))
        joined = cells.join(hot, alike).unionByName(cells.join(hot, alike, "left_anti").join(cold, alike))
    return joined.select(key, "feature", "value", "contribution")


def _explained(wide: DataFrame, leaves: Sequence[Leaf], schema: str, keep: Sequence[int] | None = None) -> DataFrame:
    """Replace the vector ``x`` of every row, its last column, by the attributions ``parts``, of all features or of a few."""
    ship(wide.sparkSession)
    shared = wide.sparkSession.sparkContext.broadcast(list(leaves))
    names = [*wide.columns[:-1], "parts"]

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explainer = Explainer(shared.value)
        for batch in batches:
            if n := batch.num_rows:
                parts = explainer(batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(n, -1))
                parts = parts if keep is None else parts[:, keep]
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * parts.shape[1])
                of_rows = pa.ListArray.from_arrays(ends, pa.array(parts.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], of_rows], names)

    return wide.mapInArrow(explain, schema)


def _long(features: Sequence[str]):
    names = F.array(*[F.lit(c) for c in features])
    entries = F.arrays_zip(names.alias("feature"), F.col("values").alias("value"), F.col("parts").alias("contribution"))
    return F.inline(entries)


def attribute(
    df: DataFrame, model: PipelineModel, leaves: Sequence[Leaf], features: Sequence[str], key: str = C.KEY
) -> DataFrame:
    """Rows ``(key, feature, value, contribution)`` of a fitted tree pipeline.

    Values are the original ones as text. Rows stay in their partitions; only the
    vectors pass through Python, in Arrow batches.
    """
    wide = PipelineModel(model.stages[:-1]).transform(df).select(
        F.col(key).alias("key"),
        F.array(*[F.col(c).cast("string") for c in features]).alias("values"),
        vector_to_array("features").alias("x"),
    )
    kind = df.schema[key].dataType.simpleString()
    explained = _explained(wide, leaves, f"key {kind}, values array<string>, parts array<double>")
    return explained.select(F.col("key").alias(key), _long(features)).toDF(key, "feature", "value", "contribution")


def cell_attributions(
    df: DataFrame, model: PipelineModel, leaves: Sequence[Leaf], features: Sequence[str], wanted: Sequence[str]
) -> DataFrame:
    """Rows ``(feature, value, contribution, n)`` of the wanted features, each for n like cases.

    A tree tells two numbers apart only if a threshold lies between them. Numbers
    are moved up to the next threshold, rows that then look alike are counted, and
    one attribution serves them all.
    """
    cuts: dict[int, set[float]] = {}
    for leaf in leaves:
        for c in leaf.conditions:
            cuts.setdefault(c.feature, set()).update(t for t in (c.low, c.high) if math.isfinite(t))

    def settled(i: int):
        x, thresholds = F.get(F.col("x"), i), sorted(cuts.get(i, ()))
        if not thresholds:
            return x
        moved = F.when(x <= thresholds[0], thresholds[0])
        for t in thresholds[1:]:
            moved = moved.when(x <= t, t)
        return moved.otherwise(thresholds[-1] + 1.0)

    used = {c.feature for leaf in leaves for c in leaf.conditions}
    vector = F.array(*[settled(i) if i in used else F.lit(0.0) for i in range(len(features))])
    cells = (
        PipelineModel(model.stages[:-1])
        .transform(df)
        .select(
            F.array(*[F.col(c).cast("string") for c in wanted]).alias("values"), vector_to_array("features").alias("x")
        )
        .select("values", vector.alias("x"))
        .groupBy("values", "x")
        .agg(F.count("*").alias("n"))
        .select("values", "n", "x")
    )
    keep = [list(features).index(c) for c in wanted]
    explained = _explained(cells, leaves, "values array<string>, n bigint, parts array<double>", keep)
    return explained.select("n", _long(wanted)).toDF("n", "feature", "value", "contribution")
