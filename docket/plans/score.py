"""Scoring job: conform future cases, score them once, write predictions and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docket.operators.models import score
from docket.schema import Roles, conform_columns, conform_types
from docket.sources.ledger import SavedModel, find_model, load_saved
from docket.sources.tables import read_future, write_scores


def predictions(saved: SavedModel, future: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Columns ``(key, job, predict, probability)`` of future cases."""
    ready = conform_columns(conform_types(future), saved.schema)
    return score(saved.model, ready, roles.key, roles.job)


def score_future(
    spark: SparkSession,
    future: DataFrame,
    root: str,
    name: str,
    stage: str,
    out: str | None = None,
    roles: Roles = Roles(),
) -> tuple[DataFrame, DataFrame]:
    """Score with the model that holds a stage; evidence comes from the model directory."""
    saved = load_saved(spark, find_model(spark, root, name, stage))
    scored = predictions(saved, future, roles)
    evidence = saved.evidence.orderBy("place").select("provas", "value_importance", "impacto")
    if out:
        write_scores(scored, evidence, out)
    return scored, evidence


def score_file(
    spark: SparkSession,
    path: str,
    root: str,
    name: str,
    stage: str,
    out: str | None = None,
    roles: Roles = Roles(),
    form: str = "csv",
) -> tuple[DataFrame, DataFrame]:
    """Score a file of future cases, read with the types that training's raw table had."""
    saved = load_saved(spark, find_model(spark, root, name, stage))
    future = read_future(spark, path, saved.schema, form, saved.raw)
    return score_future(spark, future, root, name, stage, out, roles)
