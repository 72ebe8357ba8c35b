"""Additive glass-box classifier: one score per bin of each feature, and of some pairs.

Rows are compacted to cells, rows alike in all bins. Boosting never touches the
rows again: each step sums gradients of the cells per bin, which combines on the
map side, and moves the scores of one term. The scores are a few numbers per term
whatever the data, so the driver keeps them and every step's plan is short: there
is no growing lineage to cut.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from docket import constants as C
from docket.functions.draws import poisson_one
from docket.operators.binning import Bins, fit_bins
from docket.operators.dictionary import TargetCodes
from docket.operators.encode import FrequencyEncoder, NumericFill
from docket.operators.models import Prepared, fitted_per_fold
from docket.operators.screen import column_kinds
from docket.schema import Roles
from docket.session import ship, staged


@dataclass(frozen=True)
class Term:
    """A feature, or a pair of features with coarser bins, by feature number.

    ``groups`` has, for each feature of a pair, the coarse bin of every code.
    """

    features: tuple[int, ...]
    sizes: tuple[int, ...]
    groups: tuple[tuple[int, ...], ...] = ()

    @property
    def size(self) -> int:
        return int(np.prod(self.sizes))

    def code(self) -> Column:
        """The term's bin as one integer."""
        if len(self.features) == 1:
            return F.col(f"b{self.features[0]}")
        first, second = (coarse_code(f, g) for f, g in zip(self.features, self.groups))
        return first * F.lit(self.sizes[1]) + second

    def name(self, names: Sequence[str]) -> str:
        return " x ".join(names[f] for f in self.features)


def coarse_code(feature: int, groups: Sequence[int]) -> Column:
    """The coarse bin of a feature's code."""
    code = F.col(f"b{feature}")
    return code if list(groups) == list(range(len(groups))) else F.get(F.lit(list(groups)), code)


def coarse_groups(order: np.ndarray, weight: np.ndarray, size: int) -> tuple[int, ...]:
    """Coarse bins of codes ``0..n``: code 0 stays apart, the others are merged in their order into ``size`` bins of like weight."""
    n, out = len(order), np.zeros(len(order) + 1, dtype=int)
    if n <= size:
        return tuple(range(n + 1))
    mass = np.maximum(weight[order], 1e-12)
    before = np.cumsum(mass) - mass / 2
    cuts = np.floor(before / mass.sum() * size).astype(int)
    out[order + 1] = 1 + np.unique(cuts, return_inverse=True)[1]
    return tuple(out.tolist())


def quadrant_gain(g: np.ndarray, h: np.ndarray, reg: float) -> float:
    """The most that one cut in each of two features explains: the gain of four quadrants over all cuts, from running sums."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    cut = slice(1, -1)

    def gain(corner) -> np.ndarray:
        a, b = corner(g), corner(h)
        return np.divide(a * a, b + reg, out=np.zeros_like(a), where=b > 1e-12)

    corners = (
        lambda t: t[cut, cut],
        lambda t: t[cut, -1:] - t[cut, cut],
        lambda t: t[-1:, cut] - t[cut, cut],
        lambda t: t[-1:, -1:] - t[cut, -1:] - t[-1:, cut] + t[cut, cut],
    )
    total = sum(gain(c) for c in corners)
    return float(total.max()) if total.size else 0.0


def compact(codes: DataFrame, bins: Bins, key: str, bags: int = 1, seed=C.SEED) -> DataFrame:
    """Cells ``(b0, b1, ..., w)``: per bag the weight of each class among equal rows.

    One bag takes every row once. More bags draw a Poisson(1) count per row and bag.
    """
    def weight(bag: int) -> Column:
        if bags == 1:
            return F.lit(1)
        draw = F.pmod(F.xxhash64(F.col(key), F.lit(bag), F.lit(str(seed))), F.lit(1 << 32)) / F.lit(float(1 << 32))
        return poisson_one(draw)

    sums = []
    for bag in range(bags):
        w = weight(bag)
        sums.append(
            F.struct(
                F.sum(F.when(F.col("label") == 0, w).otherwise(0)).alias("w0"),
                F.sum(F.when(F.col("label") == 1, w).otherwise(0)).alias("w1"),
            )
        )
    return codes.groupBy(*bins.columns).agg(F.array(*sums).alias("w"))


def _literal(numbers, kind: str) -> Column:
    # One literal instead of thousands of expressions; the optimizer folds it once.
    return F.from_json(F.lit(json.dumps(numbers)), kind)


def margin(terms: Sequence[Term], scores: Sequence[np.ndarray], intercept: np.ndarray, bag: Column) -> Column:
    """Sum of the looked-up term scores of one bag."""
    total = F.get(_literal(intercept.tolist(), "array<double>"), bag)
    for term, table in zip(terms, scores):
        of_bag = F.get(_literal(table.tolist(), "array<array<double>>"), bag)
        total = total + F.get(of_bag, term.code())
    return total


def _per_bag(cells: DataFrame, terms, scores, intercept) -> DataFrame:
    each = cells.select("*", F.posexplode("w").alias("bag", "pair"))
    s = margin(terms, scores, intercept, F.col("bag"))
    return each.withColumn("s", s).select(
        "*",
        (1.0 / (1.0 + F.exp(-F.col("s")))).alias("p"),
        F.col("pair.w0").alias("w0"),
        F.col("pair.w1").alias("w1"),
    )


def gradients(cells: DataFrame, terms, scores, intercept, wanted: Sequence[Term]) -> DataFrame:
    """Rows ``(term, bag, code, g, h, n, loss)`` of the wanted terms, in one pass over the cells."""
    p, w0, w1, s = F.col("p"), F.col("w0"), F.col("w1"), F.col("s")
    spots = F.array(*[F.struct(F.lit(i).alias("term"), t.code().alias("code")) for i, t in enumerate(wanted)])
    return (
        _per_bag(cells, terms, scores, intercept)
        .select(
            "bag",
            (w1 * (1 - p) - w0 * p).alias("g"),
            ((w0 + w1) * p * (1 - p)).alias("h"),
            (w0 + w1).alias("n"),
            (w1 * F.log1p(F.exp(-s)) + w0 * F.log1p(F.exp(s))).alias("loss"),
            F.inline(spots),
        )
        .groupBy("term", "bag", "code")
        .agg(*[F.sum(c).alias(c) for c in ("g", "h", "n", "loss")])
    )


def runs(g: np.ndarray, h: np.ndarray, n: np.ndarray, max_leaves: int, min_samples: int, reg: float) -> list[slice]:
    """Cut ordered bins into at most ``max_leaves`` runs, best gain first."""
    gain = lambda part: g[part].sum() ** 2 / (h[part].sum() + reg) if h[part].sum() > 0 else 0.0
    parts = [slice(0, len(g))]
    while len(parts) < max_leaves:
        best = None
        for i, part in enumerate(parts):
            for cut in range(part.start + 1, part.stop):
                left, right = slice(part.start, cut), slice(cut, part.stop)
                if n[left].sum() < min_samples or n[right].sum() < min_samples:
                    continue
                won = gain(left) + gain(right) - gain(part)
                if won > 1e-12 and (best is None or won > best[0]):
                    best = (won, i, left, right)
        if best is None:
            break
        parts[best[1] : best[1] + 1] = [best[2], best[3]]
    return parts


def step_of(g, h, n, params: Mapping[str, float], pair: bool) -> np.ndarray:
    """Newton step per bin of one term in one bag."""
    reg, smallest = params["reg_lambda"], params["min_samples_leaf"]
    if pair:
        step = np.where(n >= smallest, g / np.maximum(h + reg, 1e-12), 0.0)
    else:
        step = np.zeros(len(g))
        for part in runs(g, h, n, int(params["max_leaves"]), int(smallest), reg):
            weight = h[part].sum() + reg
            step[part] = g[part].sum() / weight if weight > 1e-12 else 0.0
    return params["learning_rate"] * step


DEFAULTS = {
    "learning_rate": 0.1,
    "max_rounds": 50,
    "interactions": 10,
    "max_leaves": 3,
    "outer_bags": 8,
    "max_bins": 32,
    "max_interaction_bins": 16,
    "min_samples_leaf": 2,
    "reg_lambda": 0.0,
}

#: Pairs that one job screens.
PAIRS_PER_JOB = 128


class Boosting:
    """Term scores under construction: ``scores[t]`` has one row per bag, one column per bin.

    ``sweep="feature"`` renews the gradients after every term, one job per term.
    ``sweep="round"`` moves all terms from one job per round, for wide tables; the
    step is halved and the round undone whenever the log-loss has risen.
    """

    def __init__(self, cells: DataFrame, bins: Bins, params: Mapping[str, float], sweep: str = "feature"):
        self.cells, self.bins, self.params, self.sweep = cells, bins, params, sweep
        self.bags = int(params["outer_bags"])
        self.terms: list[Term] = []
        self.scores: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.losses: list[float] = []
        totals = cells.select(F.posexplode("w").alias("bag", "pair")).groupBy("bag").agg(
            F.sum("pair.w0").alias("w0"), F.sum("pair.w1").alias("w1")
        )
        self.intercept = np.zeros(self.bags)
        for r in totals.collect():
            self.intercept[r["bag"]] = np.log(max(r["w1"], 0.5) / max(r["w0"], 0.5))

    def statistics(self, wanted: Sequence[int]) -> dict[int, tuple[np.ndarray, ...]]:
        terms = [self.terms[i] for i in wanted]
        out = {i: tuple(np.zeros((self.bags, self.terms[i].size)) for _ in range(4)) for i in wanted}
        for r in gradients(self.cells, self.terms, self.scores, self.intercept, terms).collect():
            for part, name in zip(out[wanted[r["term"]]], ("g", "h", "n", "loss")):
                part[r["bag"], r["code"]] = r[name]
        return out

    def move(self, term: int, stats, scale: float = 1.0) -> None:
        g, h, n, _ = stats
        self.counts[term] = n
        pair = len(self.terms[term].features) == 2
        for bag in range(self.bags):
            self.scores[term][bag] += scale * step_of(g[bag], h[bag], n[bag], self.params, pair)

    def add(self, terms: Sequence[Term]) -> list[int]:
        start = len(self.terms)
        self.terms += terms
        self.scores += [np.zeros((self.bags, t.size)) for t in terms]
        self.counts += [np.zeros((self.bags, t.size)) for t in terms]
        return list(range(start, len(self.terms)))

    def run(self, wanted: Sequence[int], rounds: int) -> None:
        scale, before = 1.0, None
        for _ in range(rounds):
            if self.sweep == "feature":
                for position, term in enumerate(wanted):
                    stats = self.statistics([term])[term]
                    if position == 0:
                        self.losses.append(float(stats[3].sum() / stats[2].sum()))
                    self.move(term, stats)
                continue
            stats = self.statistics(wanted)
            loss = float(stats[wanted[0]][3].sum() / stats[wanted[0]][2].sum())
            if before is not None and loss > self.losses[-1] + 1e-12:
                scale, self.scores = scale / 2, [s.copy() for s in before[0]]
                stats = before[1]
            else:
                self.losses.append(loss)
            before = ([s.copy() for s in self.scores], stats)
            for term in wanted:
                self.move(term, stats[term], scale)

    def final_loss(self) -> float:
        g, h, n, loss = self.statistics([0])[0]
        return float(loss.sum() / n.sum())

    def pair_groups(self, max_bins: int) -> list[tuple[int, ...]]:
        """Coarse bins of every feature: numbers in their order, nominal values in the order of their main scores."""
        out = []
        for i, name in enumerate(self.bins.names):
            score, weight = self.scores[i].mean(axis=0)[1:], self.counts[i].sum(axis=0)[1:]
            order = np.argsort(score, kind="stable") if name in self.bins.nominal else np.arange(len(score))
            out.append(coarse_groups(order, weight, max_bins))
        return out

    def best_pairs(self, count: int, max_bins: int) -> list[Term]:
        """The pairs that explain most of the gradient that the main terms leave.

        A pair's score is its best gain over one cut in each feature. A job sums gradients in coarse bins for
        ``PAIRS_PER_JOB`` pairs, so a cell makes so many rows at most; a pair's bins meet in one group of
        ``(max_bins + 1) ** 2`` rows at most, and one number for each pair reaches the driver.
        """
        groups, reg = self.pair_groups(max_bins), float(self.params["reg_lambda"])
        size = [max(g) + 1 for g in groups]
        pairs = [Term((i, j), (size[i], size[j]), (groups[i], groups[j])) for i, j in combinations(range(len(groups)), 2)]
        if not pairs or count <= 0:
            return []
        gains: list[float] = []
        ship(self.cells.sparkSession)
        for start in range(0, len(pairs), PAIRS_PER_JOB):
            part = pairs[start : start + PAIRS_PER_JOB]
            sizes = [t.sizes for t in part]

            def gain(rows: pd.DataFrame) -> pd.DataFrame:
                term = int(rows["term"].iloc[0])
                g, h = np.zeros(sizes[term]), np.zeros(sizes[term])
                g.ravel()[rows["code"]], h.ravel()[rows["code"]] = rows["g"], rows["h"]
                return pd.DataFrame({"term": [term], "gain": [quadrant_gain(g, h, reg)]})

            cells = gradients(self.cells, self.terms, self.scores, self.intercept, part)
            sums = cells.groupBy("term", "code").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            found = {r["term"]: r["gain"] for r in sums.groupBy("term").applyInPandas(gain, "term int, gain double").collect()}
            gains += [found.get(i, 0.0) for i in range(len(part))]
        best = sorted(range(len(pairs)), key=lambda i: (-round(gains[i], 9), i))
        return [pairs[i] for i in best[:count]]


class AdditiveModel(Model, MLReadable, MLWritable):
    """Fitted term scores; adds ``prediction`` and ``probability`` like any Spark classifier."""

    def __init__(
        self,
        bins: Bins | None = None,
        terms: Sequence[Term] = (),
        scores=(),
        intercept: float = 0.0,
        source: Mapping[str, str] | None = None,
    ):
        super().__init__()
        self.bins, self.terms, self.intercept = bins, list(terms), float(intercept)
        self.scores = [np.asarray(s, dtype=float) for s in scores]
        # Encoded column -> the case column it was made from.
        self.source = dict(source or {})

    @property
    def names(self) -> list[str]:
        """Case columns in the order of the bins."""
        return [self.source.get(n, n) for n in self.bins.names]

    def _coded(self, df: DataFrame) -> DataFrame:
        return self.bins.apply(df, df.columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = margin(self.terms, [t[None, :] for t in self.scores], np.array([self.intercept]), F.lit(0))
        p = 1.0 / (1.0 + F.exp(-F.col("__s")))
        return self._coded(dataset).withColumn("__s", s).select(
            *dataset.columns,
            F.col("__s").alias("margin"),
            array_to_vector(F.array(1 - p, p)).alias("probability"),
            (p > 0.5).cast("double").alias("prediction"),
        )

    def term_table(self, spark) -> DataFrame:
        """Rows ``(term, name, code, score)``."""
        rows = [
            (i, t.name(self.names), code, float(score))
            for i, (t, table) in enumerate(zip(self.terms, self.scores))
            for code, score in enumerate(table)
        ]
        return spark.createDataFrame(rows, "term int, name string, code int, score double")

    def attribute(self, df: DataFrame, key: str) -> DataFrame:
        """Rows ``(key, feature, value, contribution)``: the term scores are the explanation.

        A pair's score is split evenly between its two features.
        """
        names = self.names
        parts = {i: F.lit(0.0) for i in range(len(names))}
        for term, table in zip(self.terms, self.scores):
            share = F.get(_literal(table.tolist(), "array<double>"), term.code()) / len(term.features)
            for f in term.features:
                parts[f] = parts[f] + share
        entries = F.array(
            *[
                F.struct(
                    F.lit(n).alias("feature"), F.col(n).cast("string").alias("value"), parts[i].alias("contribution")
                )
                for i, n in enumerate(names)
            ]
        )
        return self._coded(df).select(key, F.inline(entries))

    def write(self) -> MLWriter:
        return _AdditiveWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _AdditiveReader()


class _AdditiveWriter(MLWriter):
    def __init__(self, model: AdditiveModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession)
        shape = {
            "nominal": m.bins.nominal,
            "numeric": m.bins.numeric,
            "intercept": m.intercept,
            "source": m.source,
            "terms": [[t.features, t.sizes, t.groups] for t in m.terms],
        }
        self.sparkSession.createDataFrame([(json.dumps(shape),)], "value string").coalesce(1).write.text(f"{path}/shape")
        m.term_table(self.sparkSession).write.parquet(f"{path}/terms")


class _AdditiveReader(MLReader):
    def load(self, path: str) -> AdditiveModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        shape = json.loads(self.sparkSession.read.text(f"{path}/shape").first()[0])
        terms = [Term(tuple(f), tuple(s), tuple(map(tuple, g))) for f, s, g in shape["terms"]]
        scores = [np.zeros(t.size) for t in terms]
        for r in self.sparkSession.read.parquet(f"{path}/terms").collect():
            scores[r["term"]][r["code"]] = r["score"]
        model = AdditiveModel(Bins(shape["nominal"], shape["numeric"]), terms, scores, shape["intercept"], shape["source"])
        model._resetUid(metadata["uid"])
        return model


class AdditiveFit:
    """How the additive model is fitted: frequencies and means, bins, cells, boosting."""

    def __init__(
        self, df: DataFrame, roles: Roles = Roles(), max_rounds: int | None = None, sweep: str = "feature"
    ):
        self.roles, self.max_rounds, self.sweep = roles, max_rounds, sweep
        categorical = roles.categorical(df)
        self.high, self.wide, self.nominal = column_kinds(df, categorical)
        self.numeric = roles.numeric(df)
        self.freq, self.fill = [f"__freq_{c}" for c in self.high], [f"__num_{c}" for c in self.numeric]
        self.target = [f"__target_{c}" for c in self.wide]
        self.losses: list[float] = []

    def prepare(self, train: DataFrame) -> Prepared:
        """Fit frequencies and means and write the encoded rows; bins depend on the parameters."""
        stages: list = []
        if self.high:
            stages.append(FrequencyEncoder(inputCols=self.high, outputCols=self.freq, spreadCol=self.roles.key))
        if self.wide:
            stages.append(TargetCodes(inputCols=self.wide, outputCols=self.target, spreadCol=self.roles.key))
        if self.numeric:
            stages.append(NumericFill(inputCols=self.numeric, outputCols=self.fill, strategy="mean"))
        encoder = Pipeline(stages=stages).fit(train)
        columns = [self.roles.key, "label", *self.nominal, *self.freq, *self.target, *self.fill]
        return Prepared(encoder, staged(encoder.transform(train).select(*columns), "encoded"))

    def prepare_folds(self, df: DataFrame, folds: int, threads: int = 4) -> list[tuple[Prepared, DataFrame]]:
        """For every fold, what :meth:`prepare` makes of the rows outside, and the encoded rows inside."""
        return fitted_per_fold(self, df, folds, threads)

    def learn(self, prepared: Prepared, params: Mapping[str, float]) -> AdditiveModel:
        """Bin, compact and boost prepared rows."""
        p = {**DEFAULTS, **params}
        if self.max_rounds is not None:
            p["max_rounds"] = min(p["max_rounds"], self.max_rounds)
        ready = prepared.rows
        bins = fit_bins(ready, self.nominal, [*self.freq, *self.target, *self.fill], int(p["max_bins"]))
        cells = compact(bins.apply(ready, [self.roles.key, "label"]), bins, self.roles.key, int(p["outer_bags"]))
        cells = staged(cells, "cells").persist()
        boosting = Boosting(cells, bins, p, self.sweep)
        mains = boosting.add([Term((i,), (bins.size(n),)) for i, n in enumerate(bins.names)])
        boosting.run(mains, int(p["max_rounds"]))
        pairs = boosting.add(boosting.best_pairs(int(p["interactions"]), int(p["max_interaction_bins"])))
        if pairs:
            boosting.run(pairs, int(p["max_rounds"]))
        self.losses = [*boosting.losses, boosting.final_loss()]
        cells.unpersist()
        scores, intercept = [], float(boosting.intercept.mean())
        for table, counts in zip(boosting.scores, boosting.counts):
            # Centre every term, so the intercept is the mean margin.
            mean, weight = table.mean(axis=0), counts.sum(axis=0)
            shift = float((mean * weight).sum() / weight.sum()) if weight.sum() else 0.0
            scores.append(mean - shift)
            intercept += shift
        source = dict(zip([*self.freq, *self.target, *self.fill], [*self.high, *self.wide, *self.numeric]))
        return AdditiveModel(bins, boosting.terms, scores, intercept, source)

    def __call__(self, train: DataFrame, params: Mapping[str, float]) -> PipelineModel:
        prepared = self.prepare(train)
        return PipelineModel([*prepared.encoder.stages, self.learn(prepared, params)])


def first_round(codes: DataFrame, bins: Bins, learning_rate: float = 0.1) -> DataFrame:
    """Rows ``(feature, code, score)`` after one cyclic round without merging or bags."""
    params = {**DEFAULTS, "learning_rate": learning_rate, "outer_bags": 1, "max_leaves": 10**6, "min_samples_leaf": 1}
    cells = staged(compact(codes, bins, C.KEY), "cells").persist()
    boosting = Boosting(cells, bins, params)
    mains = boosting.add([Term((i,), (bins.size(n),)) for i, n in enumerate(bins.names)])
    boosting.run(mains, 1)
    cells.unpersist()
    rows = [
        (bins.names[t], code, float(boosting.scores[t][0][code]))
        for t in mains
        for code in np.flatnonzero(boosting.counts[t][0]).tolist()
    ]
    return codes.sparkSession.createDataFrame(rows, "feature string, code int, score double")
