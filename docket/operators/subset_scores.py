"""Score any number of feature subsets in one job.

Rows are compacted to cells, rows alike in label, fold and all codes. A fold's
log-odds come from the other folds' counts, so a subset's prediction is a sum of
looked-up numbers and needs no model fit of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from docket.operators.binning import Bins
from docket.operators.metrics import macro_f1
from docket.session import ship


def compact(codes: DataFrame, bins: Bins) -> DataFrame:
    """Cells ``(fold, label, b0, b1, ..., n)``."""
    return codes.groupBy("fold", "label", *bins.columns).agg(F.count("*").alias("n"))


def fold_log_odds(cells: DataFrame, bins: Bins, folds: int) -> DataFrame:
    """Rows ``(feature, code, fold, odds)``: add-one log-odds from the other folds."""
    n, label = F.col("n"), F.col("label")
    outside = [
        F.sum(F.when((F.col("fold") != f) & (label == y), n).otherwise(0)).alias(f"f{f}_{y}")
        for f in range(1, folds + 1)
        for y in (0, 1)
    ]
    wide = (
        cells.unpivot(["fold", "label", "n"], bins.columns, "feature", "code").groupBy("feature", "code").agg(*outside)
    )
    long = wide.select(
        "feature",
        "code",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("fold"), F.col(f"f{f}_0").alias("n0"), F.col(f"f{f}_1").alias("n1"))
                    for f in range(1, folds + 1)
                ]
            )
        ),
    )
    # At most a thousand codes per feature: these windows stay small.
    feature = Window.partitionBy("feature", "fold")
    share = lambda c: F.log((F.col(c) + 1.0) / (F.sum(c).over(feature) + F.count("*").over(feature)))
    return long.select("feature", "code", "fold", (share("n1") - share("n0")).alias("odds"))


def odds_arrays(odds: DataFrame, bins: Bins, folds: int) -> np.ndarray:
    """Log-odds as an array ``[fold, feature, code]``; its size is bounded by the bins."""
    place = {column: i for i, column in enumerate(bins.columns)}
    out = np.zeros((folds + 1, len(place), max(bins.size(n) for n in bins.names)))
    for r in odds.collect():
        out[r["fold"], place[r["feature"]], r["code"]] = r["odds"]
    return out


def subset_confusions(cells: DataFrame, bins: Bins, odds: np.ndarray, masks: Sequence[Sequence[int]]) -> DataFrame:
    """Rows ``(mask, fold, label, prediction, n)`` for subsets given as feature numbers.

    Each task adds its cells up to one row per subset, fold, label and prediction
    before the shuffle.
    """
    folds, features = odds.shape[0], odds.shape[1]
    member = np.zeros((features, len(masks)))
    for m, mask in enumerate(masks):
        member[list(mask), m] = 1.0
    columns = bins.columns

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yes = np.zeros((folds * 2, len(masks)), dtype=np.int64)
        rows = np.zeros(folds * 2, dtype=np.int64)
        for batch in batches:
            fold, codes = batch["fold"].to_numpy(), batch[columns].to_numpy()
            terms = odds[fold[:, None], np.arange(features)[None, :], codes]
            said = np.round(terms @ member, 9) > 0
            n = batch["n"].to_numpy()
            group = fold * 2 + batch["label"].to_numpy()
            for g in np.unique(group):
                inside = group == g
                yes[g] += n[inside] @ said[inside]
                rows[g] += n[inside].sum()
        used = np.flatnonzero(rows)
        for prediction, counts in ((1, yes[used]), (0, rows[used, None] - yes[used])):
            yield pd.DataFrame(
                {
                    "mask": np.tile(np.arange(len(masks)), len(used)),
                    "fold": np.repeat(used // 2, len(masks)),
                    "label": np.repeat(used % 2, len(masks)),
                    "prediction": prediction,
                    "n": counts.reshape(-1),
                }
            )

    ship(cells.sparkSession)
    partial = cells.mapInPandas(count, "mask int, fold int, label int, prediction int, n bigint")
    return partial.groupBy("mask", "fold", "label", "prediction").agg(F.sum("n").alias("n")).filter("n > 0")


def subset_scores(
    cells: DataFrame, bins: Bins, odds: np.ndarray, masks: Sequence[Sequence[int]], average: str = "fold"
) -> DataFrame:
    """Rows ``(mask, macro_f1)``, one per subset."""
    return macro_f1(subset_confusions(cells, bins, odds, masks), ("mask",), average)
