"""Saved models and an append-only ledger of runs and stages."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docket.constants import METRICS
from docket.schema import load_schema, save_schema

RUN_FORMAT = "yyyy-MM-dd_HH:mm:ss"


@dataclass(frozen=True)
class SavedModel:
    """What a model directory holds."""

    model: PipelineModel
    schema: T.StructType
    outputs: T.StructType
    evidence: DataFrame
    raw: T.StructType


def run_name(kind, at=None):
    """Text of a run's name: its kind and the time."""
    return F.concat_ws("_", kind, F.date_format(at if at is not None else F.current_timestamp(), RUN_FORMAT))


def save_model(
    spark: SparkSession,
    root: str,
    model: PipelineModel,
    schema: T.StructType,
    outputs: T.StructType,
    evidence: DataFrame,
    raw: T.StructType | None = None,
) -> tuple[str, str]:
    """Write model, signature (input and output schema) and evidence to a directory of their own.

    ``raw`` has the types of the input before it was conformed; files of future cases are read with it.
    """
    run_id = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/models/{run_id}"
    model.write().overwrite().save(f"{path}/model")
    save_schema(spark, schema, f"{path}/schema")
    save_schema(spark, outputs, f"{path}/outputs")
    save_schema(spark, raw or schema, f"{path}/raw")
    evidence.coalesce(1).write.mode("overwrite").parquet(f"{path}/evidence")
    return run_id, path


def load_saved(spark: SparkSession, path: str) -> SavedModel:
    """Read a model directory back."""
    return SavedModel(
        PipelineModel.load(f"{path}/model"),
        load_schema(spark, f"{path}/schema"),
        load_schema(spark, f"{path}/outputs"),
        spark.read.parquet(f"{path}/evidence"),
        load_schema(spark, f"{path}/raw"),
    )


def record_run(
    spark: SparkSession,
    root: str,
    experiment: str,
    kind: str,
    run_id: str,
    path: str,
    params: Mapping[str, float],
    metrics: DataFrame,
) -> None:
    """Append one run: its true kind, parameters and the seven metrics."""
    values = F.map_from_arrays(
        F.array(*[F.lit(p) for p in params]).cast("array<string>"),
        F.array(*[F.lit(float(v)) for v in params.values()]).cast("array<double>"),
    )
    now = F.current_timestamp()
    row = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        run_name(F.lit(kind), now).alias("run_name"),
        F.lit(kind).alias("kind"),
        F.lit(path).alias("path"),
        values.alias("params"),
        *METRICS,
        now.alias("recorded_at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/runs")


def promote(spark: SparkSession, root: str, run_id: str, name: str, stage: str) -> None:
    """Give a run's model a name and a stage from now on."""
    row = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(stage).alias("stage"),
        F.lit(run_id).alias("run_id"),
        F.lit(f"{root.rstrip('/')}/models/{run_id}").alias("path"),
        F.current_timestamp().alias("promoted_at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/stages")


def latest_models(stages: DataFrame) -> DataFrame:
    """Rows ``(name, stage, run_id, path)``: the model promoted last, by a combining aggregate."""
    last = F.max_by(F.struct("run_id", "path"), F.struct("promoted_at", "run_id"))
    return stages.groupBy("name", "stage").agg(last.alias("m")).select("name", "stage", "m.run_id", "m.path")


def find_model(spark: SparkSession, root: str, name: str, stage: str) -> str:
    """Directory of the model that holds a stage."""
    stages = spark.read.parquet(f"{root.rstrip('/')}/stages")
    found = latest_models(stages.filter((F.col("name") == name) & (F.col("stage") == stage))).first()
    if found is None:
        raise LookupError(f"no model named {name} in stage {stage}")
    return found["path"]


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The recorded runs."""
    return spark.read.parquet(f"{root.rstrip('/')}/runs")
