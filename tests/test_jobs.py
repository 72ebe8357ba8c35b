"""The four jobs end to end on the smallest data folder."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from docket import constants as C
from docket.operators import metrics, models, resample
from docket.operators.additive import AdditiveFit
from docket.operators.attribution import attribute, base_value, cell_attributions, tree_leaves
from docket.operators.evidence import value_totals
from docket.plans.explore import explore
from docket.plans.prepare import SelectorSettings, prepare
from docket.plans.score import score_file, score_future
from docket.plans.train import TrainSettings, train, training_frame
from docket.operators.screen import drop_low_variance
from docket.schema import Roles, conform_types
from docket.session import scratch_path, working_dir
from docket.sources import ledger, tables
from docket.sources.cases import cases

ROLES = Roles()


@pytest.fixture(scope="module")
def frame(spark, folder):
    return training_frame(drop_low_variance(conform_types(cases(spark, folder)))[0], ROLES, 3)


def macro(scored):
    return metrics.metrics(metrics.confusion(scored)).first()["macro_f1"]


def test_explore(spark, folder):
    reports, kept = explore(cases(spark, folder))
    assert {"class_balance", "screen", "numeric_profile", "categorical_profile"} <= set(reports)
    assert "prova_6" not in kept.columns and "prova_1" in kept.columns


@pytest.mark.parametrize("kind", ["boosted", "bagged"])
def test_tree_models(spark, frame, kind):
    fit = models.TreeFit(frame, kind, max_trees=8)
    params = {"n_estimators": 100, "num_leaves": 8, "learning_rate": 0.3}
    model = fit(frame, params)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first, second = (models.score(m, frame, C.KEY, "cargo").orderBy(C.KEY).collect() for m in (model, again))
    assert first == second and len(first) == frame.count()
    leaves, scale = tree_leaves(spark, again.stages[-1])
    parts = attribute(frame, again, leaves, fit.features)
    sums = parts.groupBy(C.KEY).agg(F.sum("contribution").alias("c"))
    raw = 2 * F.get(vector_to_array("rawPrediction"), 1) if scale == "log_odds" else F.get(vector_to_array("probability"), 1)
    gap = F.abs(raw - F.col("c") - base_value(leaves))
    assert again.transform(frame).join(sums, C.KEY).agg(F.max(gap)).first()[0] < 1e-9
    flags = ROLES.evidence(frame)
    by_row = value_totals(parts.filter(F.col("feature").isin(flags))).orderBy("feature", "value").collect()
    by_cell = value_totals(cell_attributions(frame, again, leaves, fit.features, flags)).orderBy("feature", "value").collect()
    assert [r[:5] for r in by_row] == [r[:5] for r in by_cell]
    assert [r["sum_abs"] for r in by_row] == pytest.approx([r["sum_abs"] for r in by_cell])
    scored = models.out_of_fold(frame, fit, params, folds=3)
    assert scored.select(C.KEY).distinct().count() == scored.count() == frame.count()
    assert macro(scored) > macro(resample.dummy_predictions(frame, C.KEY, "label")) + 0.2


def test_weights_and_repeated_rows_train_alike(frame):
    params = {"n_estimators": 3, "num_leaves": 4, "learning_rate": 0.3}
    by_weight = models.score(models.TreeFit(frame, "boosted")(frame, params), frame, C.KEY)
    by_rows = models.score(models.TreeFit(frame, "boosted", balance="rows")(frame, params), frame, C.KEY)
    a, b = by_weight.agg(F.avg("predict")).first()[0], by_rows.agg(F.avg("predict")).first()[0]
    assert a == pytest.approx(b, abs=0.05)


@pytest.mark.parametrize("sweep", ["feature", "round"])
def test_additive_model(spark, frame, sweep):
    fit = AdditiveFit(frame, sweep=sweep)
    params = {"max_rounds": 3, "interactions": 1, "outer_bags": 2, "learning_rate": 0.3, "max_bins": 8}
    model = fit(frame, params)
    assert all(a >= b - 1e-9 for a, b in zip(fit.losses, fit.losses[1:]))
    path = scratch_path(spark, "additive")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first, second = (models.score(m, frame, C.KEY).orderBy(C.KEY).collect() for m in (model, again))
    assert first == second
    encoded = PipelineModel(again.stages[:-1]).transform(frame)
    parts = again.stages[-1].attribute(encoded, C.KEY).groupBy(C.KEY).agg(F.sum("contribution").alias("c"))
    gap = F.abs(F.col("margin") - F.col("c") - again.stages[-1].intercept)
    assert again.transform(frame).join(parts, C.KEY).agg(F.max(gap)).first()[0] < 1e-9
    assert macro(models.score(again, frame, "label").withColumnRenamed("predict", "prediction")) > 0.7


def test_prepare_train_and_score(spark, folder):
    raw = cases(spark, folder)
    path, root = scratch_path(spark, "prepared"), scratch_path(spark, "root")
    settings = SelectorSettings(keep=5, max_bins=8, folds=3, shadow_rounds=2, shadow_trees=5, population=10, generations=2)
    prepared, votes = prepare(raw, path, settings=settings)
    assert all(not r["removed"] for r in votes.collect() if r["feature"].startswith("prova"))
    stored = tables.read_prepared(spark, path)
    assert stored.columns == prepared.columns and stored.count() == raw.count()

    quick = TrainSettings(trials=2, folds=2, overrides={"n_estimators": 4, "num_leaves": 8})
    run = train(stored, root, "bagged", settings=quick)
    assert run["results"].count() == 2
    assert [r["provas"] for r in run["evidence"].orderBy("place").collect()][0] in ("prova_1", "prova_3")
    recorded = ledger.runs(spark, root).first()
    assert recorded["kind"] == "bagged" and recorded["run_name"].startswith("bagged_")
    assert recorded["accuracy"] > 0.6 and recorded["params"]["n_estimators"] == 4

    with pytest.raises(LookupError):
        ledger.promote(spark, root, run["run_id"], "outcome", "Staging")
        ledger.find_model(spark, root, "outcome", "Production")
    ledger.promote(spark, root, run["run_id"], "outcome", "Production")
    saved = ledger.load_saved(spark, run["path"])
    assert C.TARGET not in saved.schema.names and saved.outputs.names == [C.KEY, "cargo", "predict", "probability"]
    out = f"{root}/out"
    scored, proof = score_future(spark, raw, root, "outcome", "Production", out)
    assert scored.columns == [C.KEY, "cargo", "predict", "probability"]
    assert scored.agg(F.min("probability")).first()[0] >= 0.5
    written = spark.read.option("header", True).csv(f"{out}/predictions")
    assert written.count() == raw.count()
    assert spark.read.option("header", True).csv(f"{out}/evidences").columns == ["provas", "value_importance", "impacto"]
    with pytest.raises(ValueError, match="absent"):
        score_future(spark, raw.drop("cargo"), root, "outcome", "Production")


def test_raw_csv_is_inferred_once(spark, folder):
    path = scratch_path(spark, "csv")
    tables.write_csv(cases(spark, folder), path)
    inferred = tables.read_raw(spark, path, schema_path=f"{path}.schema")
    assert conform_types(inferred).filter("vt = 'True'").count() > 0
    from docket.schema import load_schema

    assert tables.read_raw(spark, path, load_schema(spark, f"{path}.schema")).schema == inferred.schema


def test_train_leaves_only_its_outputs(spark, folder, tmp_path):
    import glob

    made = lambda: set(glob.glob(f"{working_dir(spark).removeprefix('file:')}/docket-*"))
    stored = cases(spark, folder)
    before = made()
    run = train(stored, str(tmp_path), "bagged", settings=TrainSettings(trials=1, folds=2, overrides={"n_estimators": 3, "num_leaves": 4}))
    assert made() == before and run["rows_without_target"] == 0
    assert models.score(run["model"], conform_types(stored), C.KEY).count() == stored.count()


def test_future_cases_from_a_file(spark, folder, tmp_path):
    past = cases(spark, folder)
    root = str(tmp_path / "root")
    quick = TrainSettings(trials=1, folds=2, overrides={"n_estimators": 3, "num_leaves": 4})
    run = train(past, root, "bagged", settings=quick)
    ledger.promote(spark, root, run["run_id"], "outcome", "Production")
    tables.write_csv(past, str(tmp_path / "future"))
    by_table, _ = score_future(spark, past, root, "outcome", "Production")
    by_file, _ = score_file(spark, str(tmp_path / "future"), root, "outcome", "Production")
    assert sorted(map(tuple, by_file.collect())) == sorted(map(tuple, by_table.collect()))


CORES = """
import sys
sys.path.insert(0, sys.argv[1])
from docket.session import local_session
from docket.checks.queries import QUERIES
spark = local_session("cores", sys.argv[3], 4)
for name in ("gbt_scores", "forest_scores"):
    rows = QUERIES[name](spark, sys.argv[2]).orderBy("codigo_processo").collect()
    print(name, hash(tuple((r[0], r[2], round(r[3], 9)) for r in rows)))
"""


def test_models_do_not_depend_on_cores(folder):
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONHASHSEED": "0", "DOCKET_DRIVER_MEMORY": "4g"}
    said = [
        subprocess.run([sys.executable, "-c", CORES, here, folder, n], capture_output=True, text=True, env=env, check=True).stdout
        for n in ("2", "4", "8")
    ]
    assert said[0] and said[0] == said[1] == said[2]
