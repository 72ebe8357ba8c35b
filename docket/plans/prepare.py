"""Feature job: screen, four selectors, vote, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.operators.binning import Bins, selection_frame
from docket.operators.screen import drop_low_variance
from docket.operators.selection import (
    CellScorer,
    ForestScorer,
    bottom_features,
    forward_selection,
    genetic_selection,
    mutual_information,
    shadow_selection,
    vote,
)
from docket.schema import Roles, conform_types
from docket.session import staged
from docket.sources.tables import write_prepared


@dataclass(frozen=True)
class SelectorSettings:
    """Sizes of the selectors; the defaults are those of the method."""

    keep: int = C.KEEP_FEATURES
    max_bins: int = 16
    folds: int = C.SELECTOR_FOLDS
    scorer: str = "cells"
    shadow_rounds: int = C.SHADOW_ROUNDS
    shadow_trees: int = 50
    population: int = C.POPULATION
    generations: int = C.GENERATIONS
    patience: int = C.GENERATIONS_WITHOUT_GAIN


def selector_drops(codes: DataFrame, bins: Bins, key: str, settings: SelectorSettings) -> DataFrame:
    """Rows ``(selector, feature)``: what each of the four selectors would drop."""
    spark = codes.sparkSession
    names, k = bins.names, settings.keep
    kinds = {"cells": CellScorer, "forest": ForestScorer}
    scorer = kinds[settings.scorer](codes, bins, settings.folds)
    label = spark.createDataFrame(list(zip(bins.columns, names)), "feature string, name string")

    shadows = shadow_selection(codes, bins, key, settings.shadow_rounds, settings.shadow_trees)
    shadow = shadows.filter(F.col("place") > k).select("feature")
    information = (
        bottom_features(mutual_information(codes, bins.columns), "mi", k)
        .join(F.broadcast(label), "feature")
        .select(F.col("name").alias("feature"))
    )
    everything = label.select(F.col("name").alias("feature"))
    forward = everything.join(forward_selection(spark, names, scorer, k).select("feature"), "feature", "left_anti")
    history = genetic_selection(
        spark, names, scorer, k, settings.population, settings.generations, settings.patience
    )
    best = history.agg(F.max_by("features", "generation").alias("f")).select(F.explode("f").alias("feature"))
    genetic = everything.join(best, "feature", "left_anti")
    drops = None
    for name, part in (("shadow", shadow), ("forward", forward), ("information", information), ("genetic", genetic)):
        part = part.select(F.lit(name).alias("selector"), "feature")
        drops = part if drops is None else drops.unionByName(part)
    return drops


def prepare(
    raw: DataFrame,
    path: str | None = None,
    roles: Roles = Roles(),
    settings: SelectorSettings = SelectorSettings(),
    form: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    """The prepared table, raw values and nulls kept, and the vote that shaped it.

    Raw cases come as text files. They are parsed once; the job's passes read columns.
    """
    screened, _ = drop_low_variance(staged(conform_types(raw), "raw"), roles)
    codes, bins = selection_frame(screened, roles, settings.max_bins, settings.folds)
    votes = staged(vote(selector_drops(codes, bins, roles.key, settings)), "votes")
    removed = [r["feature"] for r in votes.filter("removed").collect()]
    prepared = screened.drop(*removed)
    if path:
        write_prepared(prepared, path, form)
    return prepared, votes
