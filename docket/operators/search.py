"""Hyper-parameter search: a seeded table of trials, each scored out of fold."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from docket import constants as C
from docket.functions.draws import loguniform, quniform, uniform
from docket.operators.metrics import confusion, metrics
from docket.session import side_by_side


def draw_parameters(trials: DataFrame, space, trial: str = "trial", seed=C.SEED) -> DataFrame:
    """Add one drawn column per parameter of a search space to a table of trial numbers."""

    def drawn(name, law, low, high, step):
        u = uniform(F.concat(F.col(trial).cast("string"), F.lit(f":{name}:{seed}")))
        if law == "loguniform":
            return loguniform(u, low, high)
        if law == "quniform":
            return quniform(u, low, high, step)
        return F.lit(float(low)) + u * F.lit(float(high) - float(low))

    return trials.select(trial, *[drawn(*p).alias(p[0]) for p in space])


def trial_table(spark: SparkSession, kind: str, trials: int = C.TRIALS, seed=C.SEED) -> DataFrame:
    """One row per trial with parameters drawn by the laws of its kind's space."""
    return draw_parameters(spark.range(trials).withColumnRenamed("id", "trial"), C.SPACES[kind], seed=seed)


def best_trial(results: DataFrame, score: str = "macro_f1", trial: str = "trial", by: tuple = ()) -> DataFrame:
    """The trial with the highest score, the lowest number on ties."""
    rest = [c for c in results.columns if c not in by]
    top = F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(trial)))
    return results.groupBy(*by).agg(top.alias("best")).select(*by, "best.*")


def search(
    df: DataFrame,
    fit,
    kind: str,
    trials: int = C.TRIALS,
    folds: int = C.TRAIN_FOLDS,
    key: str = C.KEY,
    seed=C.SEED,
    threads: int = 4,
    overrides: Mapping[str, float] | None = None,
) -> DataFrame:
    """Rows ``(trial, <parameters>, <metrics>, macro_f1)`` of the pooled out-of-fold rows.

    Encoding and balance do not depend on the parameters, so the folds are prepared
    once and serve all trials. Every (trial, fold) pair is then an
    independent Spark job that hands four counts to the driver. ``overrides`` fixes
    parameters, for instance fewer trees in a trial run.
    """
    spark = df.sparkSession
    names = [p[0] for p in C.SPACES[kind]]
    fixed = dict(overrides or {})
    drawn = {
        r["trial"]: {**{n: float(r[n]) for n in names}, **fixed}
        for r in trial_table(spark, kind, trials, seed).collect()
    }

    prepared = fit.prepare_folds(df, folds, threads)

    def judge(task):
        trial, fold = task
        ready, valid = prepared[fold]
        scored = fit.learn(ready, drawn[trial]).transform(valid)
        return [(trial, r["label"], r["prediction"], r["n"]) for r in confusion(scored).collect()]

    tasks = [(trial, fold) for trial in drawn for fold in range(folds)]
    with ThreadPoolExecutor(max_workers=side_by_side(spark, threads, max(ready.n for ready, _ in prepared))) as pool:
        counted = list(pool.map(inheritable_thread_target(spark)(judge), tasks))
    counts = spark.createDataFrame(
        [row for part in counted for row in part], "trial bigint, label int, prediction int, n bigint"
    )
    fields = ", ".join(f"{n} double" for n in names)
    table = spark.createDataFrame([(t, *[float(p[n]) for n in names]) for t, p in drawn.items()], f"trial bigint, {fields}")
    return table.join(F.broadcast(metrics(counts, ("trial",))), "trial")
