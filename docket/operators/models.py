"""Boosted and bagged trees as Spark ML pipelines, out-of-fold prediction and scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.operators.cell_trees import fit_boosted
from docket.operators.dictionary import TargetCodes
from docket.operators.encode import FrequencyEncoder, NumericFill
from docket.operators.fold_table import FoldTable
from docket.operators.resample import oversample, oversample_copies
from docket.operators.screen import column_kinds
from docket.schema import Roles
from docket.session import by_key, side_by_side, staged


def tree_params(kind: str, params: Mapping[str, float], max_trees: int | None = None) -> dict:
    """Spark parameters nearest to the search space's names.

    ``num_leaves`` becomes a depth. ``reg_alpha`` and ``reg_lambda`` have no
    counterpart in Spark's trees; the larger of them, scaled down, asks for a
    minimum gain. ``subsample_freq`` has none either: Spark draws rows per tree.
    """
    out: dict = {}
    if "num_leaves" in params:
        out["maxDepth"] = min(30, max(1, math.ceil(math.log2(params["num_leaves"]))))
    if "subsample" in params:
        out["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        out["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    if "min_child_samples" in params:
        out["minInstancesPerNode"] = int(params["min_child_samples"])
    trees = params.get("n_estimators")
    if trees is not None:
        trees = int(trees) if max_trees is None else min(int(trees), max_trees)
    if kind == "boosted":
        if "learning_rate" in params:
            out["stepSize"] = float(params["learning_rate"])
        if trees is not None:
            out["maxIter"] = trees
        if "reg_alpha" in params or "reg_lambda" in params:
            out["minInfoGain"] = 1e-3 * max(params.get("reg_alpha", 0.0), params.get("reg_lambda", 0.0))
    else:
        out["minInstancesPerNode"] = 1
        if trees is not None:
            out["numTrees"] = trees
    return out


def classifier(kind: str, params: Mapping[str, float], max_trees: int | None, max_bins: int):
    """The tree learner of a kind: ``boosted`` or ``bagged``."""
    make = {"boosted": GBTClassifier, "bagged": RandomForestClassifier}[kind]
    return make(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        seed=C.SEED,
        maxBins=max_bins,
        maxMemoryInMB=512,
        **tree_params(kind, params, max_trees),
    )


@dataclass(frozen=True)
class Kinds:
    """How each feature of a table is encoded; the order is that of the feature vector."""

    high: list[str]
    wide: list[str]
    nominal: list[str]
    numeric: list[str]

    @classmethod
    def of(cls, df: DataFrame, roles: Roles, max_nominal: int = C.MAX_NOMINAL) -> Kinds:
        high, wide, nominal = column_kinds(df, roles.categorical(df), max_nominal=max_nominal)
        return cls(high, wide, nominal, roles.numeric(df))

    @property
    def features(self) -> list[str]:
        return [*self.high, *self.wide, *self.nominal, *self.numeric]

    @property
    def vector(self) -> list[str]:
        """The encoded columns."""
        named = (("__freq_", self.high), ("__target_", self.wide), ("__code_", self.nominal), ("__num_", self.numeric))
        return [f"{prefix}{c}" for prefix, columns in named for c in columns]


def feature_stages(kinds: Kinds, key: str = C.KEY) -> list:
    """Encoder stages: frequencies, dictionary codes, lists of values, filled numbers, and the vector of them.

    Only columns of at most ``max_nominal`` values have a list of their values on the driver.
    """
    stages: list = []
    if kinds.high:
        stages.append(
            FrequencyEncoder(inputCols=kinds.high, outputCols=[f"__freq_{c}" for c in kinds.high], spreadCol=key)
        )
    if kinds.wide:
        stages.append(TargetCodes(inputCols=kinds.wide, outputCols=[f"__target_{c}" for c in kinds.wide], spreadCol=key))
    if kinds.nominal:
        stages.append(
            StringIndexer(
                inputCols=kinds.nominal,
                outputCols=[f"__code_{c}" for c in kinds.nominal],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
    if kinds.numeric:
        stages.append(
            NumericFill(inputCols=kinds.numeric, outputCols=[f"__num_{c}" for c in kinds.numeric], strategy="below_min")
        )
    return [*stages, VectorAssembler(inputCols=kinds.vector, outputCol="features")]


@dataclass(frozen=True)
class Prepared:
    """The encoded, balanced training rows, their number, the most values of a nominal column, and the encoder if it was fitted on its own."""

    encoder: PipelineModel | None
    rows: DataFrame
    n: int = 0
    widest: int = 0


class TreeFit:
    """How one kind of tree model is fitted: encode, balance, learn.

    ``balance="copies"`` gives every row its number of oversampled copies as a
    weight, ``"rows"`` repeats the rows, ``None`` leaves the classes as they are.
    """

    def __init__(
        self,
        df: DataFrame,
        kind: str,
        roles: Roles = Roles(),
        balance: str | None = "copies",
        max_trees: int | None = None,
        max_nominal: int = C.MAX_NOMINAL,
    ):
        self.kind, self.roles, self.balance, self.max_trees = kind, roles, balance, max_trees
        self.kinds = Kinds.of(df, roles, max_nominal)
        self.stages, self.features = feature_stages(self.kinds, roles.key), self.kinds.features

    def balanced(self, train: DataFrame) -> DataFrame:
        """Training rows with a ``weight``, or repeated, so that the classes count alike."""
        if self.balance == "copies":
            return oversample_copies(train, self.roles.key, "label", name="weight")
        if self.balance == "rows":
            return oversample(train, self.roles.key, "label").withColumn("weight", F.lit(1.0))
        return train.withColumn("weight", F.lit(1.0))

    def prepare(self, train: DataFrame) -> Prepared:
        """Fit the encoder and balance the classes; none of it depends on the parameters."""
        encoder = Pipeline(stages=self.stages).fit(train)
        weight = F.col("weight").cast("double").alias("weight")
        rows = encoder.transform(self.balanced(train))
        ready = staged(rows.select(F.col(self.roles.key).alias("key"), "label", weight, "features"), "encoded")
        lists = [v for s in encoder.stages if isinstance(s, StringIndexerModel) for v in s.labelsArray]
        return Prepared(encoder, ready, ready.count(), max(map(len, lists), default=0))

    def prepare_folds(self, df: DataFrame, folds: int, threads: int = 4) -> list[tuple[Prepared, DataFrame]]:
        """For every fold, the training rows outside and the encoded rows inside, all read from one table."""
        return FoldTable(df, self, folds).parts()

    def learn(self, prepared: Prepared, params: Mapping[str, float]) -> Model:
        """Fit the learner on prepared rows."""
        # One bin per value and one for missing or unseen ones; 32 is Spark's default.
        learner = classifier(self.kind, params, self.max_trees, max(32, prepared.widest + 1))
        if self.kind == "boosted":
            return fit_boosted(learner, prepared.rows, prepared.n)
        # Files are split by the number of cores; the learner's input must not be.
        return learner.fit(by_key(prepared.rows, prepared.n, "key"))

    def __call__(self, train: DataFrame, params: Mapping[str, float]) -> PipelineModel:
        prepared = self.prepare(train)
        return PipelineModel([*prepared.encoder.stages, self.learn(prepared, params)])


def score(model: Model, df: DataFrame, *keep: str) -> DataFrame:
    """Columns ``(*keep, predict, probability)``: the class and the probability of that class."""
    shares = vector_to_array("probability")
    return model.transform(df).select(
        *keep,
        F.col("prediction").cast("int").alias("predict"),
        F.greatest(F.get(shares, 0), F.get(shares, 1)).alias("probability"),
    )


def each_fold(df: DataFrame, folds: int, threads: int, work: Callable) -> list:
    """Call ``work(fold, rows outside, rows inside)`` for every fold; folds are independent Spark jobs."""
    fold = F.col("fold")
    run = inheritable_thread_target(df.sparkSession)(
        lambda i: work(i, df.filter(fold != i), df.filter(fold == i))
    )
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(run, range(1, folds + 1)))


def fitted_per_fold(fit, df: DataFrame, folds: int, threads: int = 4) -> list[tuple[Prepared, DataFrame]]:
    """The same as a fit's ``prepare_folds`` with an encoder fitted and a table written for each fold."""

    def work(fold, train: DataFrame, valid: DataFrame) -> tuple[Prepared, DataFrame]:
        prepared = fit.prepare(train)
        return prepared, staged(prepared.encoder.transform(valid), f"valid-{fold}")

    return each_fold(df, folds, threads, work)


def out_of_fold(
    df: DataFrame,
    fit,
    params: Mapping[str, float],
    key: str = C.KEY,
    folds: int = C.TRAIN_FOLDS,
    threads: int = 4,
) -> DataFrame:
    """Every row scored once by a model that has not seen its fold.

    ``df`` carries ``label`` and ``fold``. Encoder and balance of a fold's model know nothing of the fold.
    """

    def work(part) -> DataFrame:
        prepared, valid = part
        scored = score(fit.learn(prepared, params), valid, key, "fold", "label")
        return scored.withColumnRenamed("predict", "prediction")

    parts = fit.prepare_folds(df, folds, threads)
    at_once = side_by_side(df.sparkSession, threads, max(prepared.n for prepared, _ in parts))
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(df.sparkSession)(work), parts))
