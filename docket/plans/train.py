"""Train job: search, refit, out-of-fold metrics, evidence, saved model, ledger row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.operators.additive import AdditiveFit, AdditiveModel
from docket.operators.attribution import attribute, cell_attributions, tree_leaves
from docket.operators.encode import label_of
from docket.operators.evidence import evidence_table, value_totals
from docket.operators.folds import stratified_folds
from docket.operators.models import TreeFit, score
from docket.operators.search import best_trial, search
from docket.schema import Roles, conform_types
from docket.session import cleared, staged
from docket.sources.ledger import load_saved, record_run, save_model


@dataclass(frozen=True)
class TrainSettings:
    """Sizes of a training run; the defaults are those of the method.

    ``sweep`` says how the additive model boosts: all terms of a round in one job
    (``"round"``), or one term for each job (``"feature"``).
    """

    trials: int = C.TRIALS
    folds: int = C.TRAIN_FOLDS
    threads: int = 4
    balance: str | None = "copies"
    max_trees: int | None = None
    max_rounds: int | None = None
    sweep: str = "round"
    overrides: Mapping[str, float] = field(default_factory=dict)
    text_fills: Mapping[str, str] = field(default_factory=dict)


def training_frame(raw: DataFrame, roles: Roles, folds: int, text_fills: Mapping[str, str] | None = None) -> DataFrame:
    """The prepared table with ``label`` and ``fold``, written once for all fits."""
    df = conform_types(raw)
    if text_fills:
        df = df.fillna({c: v for c, v in text_fills.items() if c in df.columns})
    labelled = label_of(df, roles.target).filter("label is not null")
    return staged(stratified_folds(labelled, roles.key, "label", folds), "training")


def fitter(kind: str, df: DataFrame, roles: Roles, settings: TrainSettings):
    """How a kind is fitted: ``boosted``, ``bagged`` or ``additive``."""
    if kind == "additive":
        return AdditiveFit(df, roles, settings.max_rounds, sweep=settings.sweep)
    return TreeFit(df, kind, roles, settings.balance, settings.max_trees)


def attributions(df: DataFrame, model: PipelineModel, features: list[str], key: str) -> DataFrame:
    """Rows ``(key, feature, value, contribution)`` of any fitted kind."""
    last = model.stages[-1]
    if isinstance(last, AdditiveModel):
        return last.attribute(PipelineModel(model.stages[:-1]).transform(df), key)
    leaves, _ = tree_leaves(df.sparkSession, last)
    return attribute(df, model, leaves, features, key)


def evidence_of(df: DataFrame, model: PipelineModel, features: list[str], roles: Roles) -> DataFrame:
    """The evidence table of any fitted kind; tree attributions are made once per like cases."""
    flags, last = roles.evidence(df), model.stages[-1]
    if isinstance(last, AdditiveModel):
        parts = attributions(df, model, features, roles.key).filter(F.col("feature").isin(flags))
    else:
        leaves, _ = tree_leaves(df.sparkSession, last)
        parts = cell_attributions(df, model, leaves, features, flags)
    return evidence_table(value_totals(parts), flags)


def train(
    prepared: DataFrame,
    root: str,
    kind: str = "boosted",
    roles: Roles = Roles(),
    settings: TrainSettings = TrainSettings(),
    experiment: str = "train",
) -> dict:
    """Fit one kind of model and record it; returns run id, path, model, results and evidence.

    Rows without a target cannot be learned from; their number is returned as
    ``rows_without_target``. One job runs at a time in a session.
    """
    spark = prepared.sparkSession
    names = [p[0] for p in C.SPACES[kind]]
    unlabelled = prepared.where(F.col(roles.target).isNull()).count()
    with cleared(spark):
        frame = training_frame(prepared, roles, settings.folds, settings.text_fills)
        fit = fitter(kind, frame, roles, settings)
        found = search(
            frame, fit, kind, settings.trials, settings.folds, roles.key, threads=settings.threads, overrides=settings.overrides
        )
        results = spark.createDataFrame(found.collect(), found.schema)
        winner = best_trial(results).first()
        params = {n: winner[n] for n in names}
        model = fit(frame, params)
        # Folds and seeds are fixed, so the winner's out-of-fold rows have been scored already.
        measured = best_trial(results).select(*C.METRICS, "macro_f1")
        features = fit.features if isinstance(fit, TreeFit) else []
        evidence = evidence_of(frame, model, features, roles)
        inputs = frame.drop("label", "fold", roles.target).schema
        outputs = score(model, frame, roles.key, roles.job).schema
        raw = prepared.drop(roles.target).schema
        run_id, path = save_model(spark, root, model, inputs, outputs, evidence, raw)
    record_run(spark, root, experiment, kind, run_id, path, params, measured)
    # The intermediate tables are gone; what is handed on reads the model directory.
    saved = load_saved(spark, path)
    return {
        "run_id": run_id,
        "path": path,
        "model": saved.model,
        "results": results,
        "metrics": measured,
        "evidence": saved.evidence,
        "rows_without_target": unlabelled,
    }
