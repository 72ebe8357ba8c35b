"""Balanced forests of one feature subset, for all folds at once, from counted cells.

Rows alike in fold, label and all codes of the subset are one cell. A bootstrap takes each
of a cell's n rows Poisson(1) times and so the cell Poisson(n) times: trees grown from such
draws are trees grown from draws of the rows, but a pass costs the cells and not the rows.
Trees grow level by level. Spark counts the draws that reach each open node by feature, code
and label; the driver sees these counts alone, which the bins bound, and picks the splits.
Splits, stops and votes are those of Spark's own forest classifier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.session import ship


def drawn_cells(codes: DataFrame, columns: Sequence[str], trees: int, seed: int = C.SEED) -> DataFrame:
    """Cells ``(fold, label, *columns, n, t0, t1, ...)``: the rows, and how often each tree draws them.

    The draws follow from the cell alone, whatever the partitions.
    """
    cells = codes.filter("fold is not null and label is not null").groupBy("fold", "label", *columns).agg(F.count("*").alias("n"))
    seeded = cells.withColumn("seed", F.xxhash64(F.lit(f"{seed}:{','.join(columns)}"), "fold", "label", *columns))
    names = [f"t{t}" for t in range(trees)]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            times = [np.random.default_rng(s % 2**64).poisson(n, trees) for s, n in zip(batch["seed"].tolist(), batch["n"].tolist())]
            drawn = pd.DataFrame(np.array(times, dtype=np.int64).reshape(-1, trees), columns=names, index=batch.index)
            yield pd.concat([batch.drop(columns="seed"), drawn], axis=1)

    kinds = ", ".join([f"{c} int" for c in ("fold", "label", *columns)] + [f"{c} bigint" for c in ("n", *names)])
    return seeded.mapInPandas(draw, kinds)


def code_counts(codes: DataFrame, columns: Sequence[str], folds: int) -> dict[str, np.ndarray]:
    """The rows of every column by fold, code and label, as arrays ``[fold, code, label]``; fold 0 takes rows of no fold."""
    long = codes.filter("fold is not null and label is not null").unpivot(["fold", "label"], list(columns), "feature", "code")
    rows = long.groupBy("feature", "code", "fold", "label").agg(F.count("*").alias("n")).collect()
    out = {c: np.zeros((folds + 1, 1 + max((r["code"] for r in rows), default=0), 2)) for c in columns}
    for r in rows:
        out[r["feature"]][r["fold"] if 1 <= r["fold"] <= folds else 0, r["code"], r["label"]] += r["n"]
    return out


def code_cuts(weight: np.ndarray, most: int = 31) -> np.ndarray:
    """Last codes left of the cuts between neighbouring values; of more than ``most`` those nearest to even shares of the weight."""
    present = np.flatnonzero(weight)
    between = (present[:-1] + present[1:]) // 2
    if len(between) <= most:
        return between
    target = stride = weight.sum() / (most + 1)
    passed, kept = np.cumsum(weight[present]), []
    for i, cut in enumerate(between):
        if abs(passed[i] - target) < abs(passed[i + 1] - target):
            kept.append(cut)
            target += stride
    return np.array(kept, dtype=int)


def _gini(weight: np.ndarray) -> np.ndarray:
    total = weight.sum(-1, keepdims=True)
    return 1.0 - ((weight / np.where(total > 0, total, 1.0)) ** 2).sum(-1)


class CellForest:
    """The trees of every fold over one subset; nodes are numbered as in a heap, from 0.

    ``counts`` are those of :func:`code_counts` for the subset's columns, ``weights`` the weights of the two classes.
    """

    def __init__(self, counts: Sequence[np.ndarray], weights: Sequence[float], folds: int, trees: int, depth: int = C.SELECTOR_DEPTH, seed: int = C.SEED):
        self.features, self.folds, self.trees, self.depth, self.seed = len(counts), folds, trees, depth, seed
        self.weights, self.codes = np.asarray(weights, dtype=float), max(c.shape[1] for c in counts)
        self.cuts = [[code_cuts(np.delete(c, f, axis=0).sum(0) @ self.weights) for c in counts] for f in range(1, folds + 1)]
        shape = (folds, trees, 2 ** (depth + 1) - 1)
        self.feature, self.cut = np.full(shape, -1), np.zeros(shape, dtype=int)
        self.drawn, self.open = np.zeros((*shape, 2)), np.zeros(shape, dtype=bool)
        self.open[:, :, 0] = True
        # A node tries the square root of the features, a lone tree all of them.
        self.tries = self.features if trees == 1 else math.ceil(math.sqrt(self.features))

    def reached(self, f: int, x: np.ndarray, levels: int) -> np.ndarray:
        """The node that every row of codes reaches in every tree of fold index ``f``."""
        node, tree = np.zeros((len(x), self.trees), dtype=int), np.arange(self.trees)
        for _ in range(levels):
            feature = self.feature[f][tree, node]
            right = np.take_along_axis(x, np.maximum(feature, 0), axis=1) > self.cut[f][tree, node]
            node = np.where(feature < 0, node, 2 * node + 1 + right)
        return node

    def tried(self, level: int) -> np.ndarray:
        """The features that each node of a level tries, ``[fold, tree, node, try]``."""
        out = np.tile(np.arange(self.tries), (self.folds, self.trees, 2**level, 1))
        if self.tries < self.features:
            for f, t, i in np.argwhere(self.open[:, :, 2**level - 1 : 2 ** (level + 1) - 1]):
                out[f, t, i] = np.random.default_rng([self.seed, f, t, level, i]).choice(self.features, self.tries, replace=False)
        return out

    def level_counts(self, cells: DataFrame, columns: Sequence[str], level: int, tried: np.ndarray) -> np.ndarray:
        """The draws outside each fold that reach the open nodes of a level, ``[fold, tree, node, try, code, label]``."""
        first, width, trees = 2**level - 1, 2**level, [f"t{t}" for t in range(self.trees)]
        shape = (*tried.shape, self.codes, 2)
        each = math.prod(shape[1:])

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((self.folds, each))
            for batch in batches:
                fold, label, x, times = batch["fold"].to_numpy(), batch["label"].to_numpy(), batch[list(columns)].to_numpy(), batch[trees].to_numpy()
                for f in range(self.folds):
                    outside = np.flatnonzero(fold != f + 1)
                    node = self.reached(f, x[outside], level)
                    row, tree = np.nonzero((node >= first) & self.open[f][np.arange(self.trees), node] & (times[outside] > 0))
                    place, row = node[row, tree] - first, outside[row]
                    for k in range(self.tries):
                        code = x[row, tried[f, tree, place, k]]
                        at = (((tree * width + place) * self.tries + k) * self.codes + code) * 2 + label[row]
                        sums[f] += np.bincount(at, weights=times[row, tree], minlength=each)
            for f in range(self.folds):
                at = np.flatnonzero(sums[f])
                yield pd.DataFrame({"at": at + f * each, "n": sums[f][at].astype(np.int64)})

        found = cells.mapInPandas(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(self.folds * each)
        out[found["at"].to_numpy(dtype=int)] = found["n"].to_numpy()
        return out.reshape(shape)

    def split(self, level: int, tried: np.ndarray, counts: np.ndarray) -> None:
        """Split each open node of a level where it gains most, and open its children that have both classes."""
        first = 2**level - 1
        for f, t, i in np.argwhere(self.open[:, :, first : 2 * first + 1]):
            node, whole, best = first + i, counts[f, t, i, 0].sum(0), 0.0
            if level == 0:
                self.drawn[f, t, node] = whole
            for k, j in enumerate(tried[f, t, i]):
                cuts = self.cuts[f][j]
                left = np.cumsum(counts[f, t, i, k], axis=0)[cuts]
                right = whole - left
                wl, wr, w = left * self.weights, right * self.weights, whole * self.weights
                share = wl.sum(1) / max(w.sum(), 1e-300)
                gain = _gini(w) - share * _gini(wl) - wr.sum(1) / max(w.sum(), 1e-300) * _gini(wr)
                gain[(left.sum(1) < 1) | (right.sum(1) < 1)] = -1.0
                if len(cuts) and gain.max() > best:
                    at = gain.argmax()
                    best = gain[at]
                    self.feature[f, t, node], self.cut[f, t, node] = j, cuts[at]
                    self.drawn[f, t, 2 * node + 1], self.drawn[f, t, 2 * node + 2] = left[at], right[at]
            if self.feature[f, t, node] >= 0 and level + 1 < self.depth:
                for child in (2 * node + 1, 2 * node + 2):
                    self.open[f, t, child] = self.drawn[f, t, child].min() > 0

    def prune(self) -> None:
        """Take back splits whose two leaves say the same, from the bottom up."""
        said = (self.drawn * self.weights).argmax(-1)
        for node in reversed(range(2**self.depth - 1)):
            left, right = 2 * node + 1, 2 * node + 2
            leaves = (self.feature[:, :, left] < 0) & (self.feature[:, :, right] < 0)
            same = leaves & (said[:, :, left] == said[:, :, right])
            self.feature[:, :, node][same] = -1

    def grow(self, cells: DataFrame, columns: Sequence[str]) -> CellForest:
        """Grow all trees; one job a level."""
        ship(cells.sparkSession)
        for level in range(self.depth):
            if not self.open[:, :, 2**level - 1 : 2 ** (level + 1) - 1].any():
                break
            tried = self.tried(level)
            self.split(level, tried, self.level_counts(cells, columns, level, tried))
        self.prune()
        return self

    def confusions(self, cells: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Rows ``(fold, label, prediction, n)``: the class with more of the trees' shares, the first of equals, for the rows inside each fold."""
        weight = self.drawn * self.weights
        total = weight.sum(-1, keepdims=True)
        shares = weight / np.where(total > 0, total, 1.0)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n = np.zeros((self.folds, 2, 2), dtype=np.int64)
            for batch in batches:
                fold, label, x, rows = (batch[c].to_numpy() for c in ("fold", "label", list(columns), "n"))
                for f in range(self.folds):
                    inside = np.flatnonzero(fold == f + 1)
                    votes = shares[f][np.arange(self.trees), self.reached(f, x[inside], self.depth)].sum(1)
                    np.add.at(n[f], (label[inside], (votes[:, 1] > votes[:, 0]).astype(int)), rows[inside])
            f, label, prediction = np.nonzero(n)
            yield pd.DataFrame({"fold": f + 1, "label": label, "prediction": prediction, "n": n[f, label, prediction]})

        partial = cells.mapInPandas(count, "fold int, label int, prediction int, n bigint")
        return partial.groupBy("fold", "label", "prediction").agg(F.sum("n").alias("n"))
