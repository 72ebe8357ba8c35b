"""Dictionaries of wide nominal columns, and one encoded table for all folds."""

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from docket import constants as C
from docket.operators import binning, dictionary, models, search
from docket.operators.folds import stratified_folds
from docket.operators.lookup import look_up
from docket.schema import Roles

ROLES = Roles()


def brute_codes(rows, max_codes):
    """Codes of one column from ``(value, label)`` rows."""
    rows = [(v, y) for v, y in rows if v is not None]
    share = sum(y for _, y in rows) / len(rows)
    n, n1 = {}, {}
    for v, y in rows:
        n[v], n1[v] = n.get(v, 0) + 1, n1.get(v, 0) + y
    level = {v: min(math.floor((n1[v] + 10.0 * share) / (n[v] + 10.0) * 1024), 1023) for v in n}
    mass = {}
    for v in n:
        mass[level[v]] = mass.get(level[v], 0) + n[v]
    cut, before = {}, 0
    for k in sorted(mass):
        cut[k] = math.floor(before * max_codes / len(rows))
        before += mass[k]
    place = {c: i for i, c in enumerate(sorted(set(cut.values())), 1)}
    return {v: place[cut[level[v]]] for v in n}


def wide_rows(n=3000, values=400, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"v{draw.randrange(values)}"
        y = int(draw.random() < (0.5 if v is None else 0.8 if v == "hot" else (int(v[1:]) % 10) / 10))
        rows.append((i, v, f"n{i % 4}", float(i % 17) if i % 11 else None, y))
    return rows


def frame(spark, rows, folds=4):
    df = spark.createDataFrame(rows, f"{C.KEY} long, wide string, narrow string, x double, label int")
    return stratified_folds(df, C.KEY, "label", folds)


@pytest.mark.parametrize("max_codes", [3, 255])
def test_dictionary_equals_brute_force(spark, max_codes):
    rows = wide_rows()
    df = frame(spark, rows)
    found = dictionary.dictionary(dictionary.fold_counts(df, ["wide", "narrow"], "label", 4), max_codes, 4).collect()
    fold = {r[C.KEY]: r["fold"] for r in df.select(C.KEY, "fold").collect()}
    for place, feature in ((1, "wide"), (2, "narrow")):
        views = [brute_codes([(r[place], r[4]) for r in rows if fold[r[0]] != k], max_codes) for k in range(5)]
        got = {r["value"]: r for r in found if r["feature"] == feature}
        assert set(got) == set(views[0])
        for value, r in got.items():
            assert r["code"] == views[0][value]
            assert list(r["codes"]) == [views[k].get(value) for k in range(1, 5)]
    assert max(r["code"] for r in found) <= max_codes


def test_empty_and_null_columns_have_no_codes(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 0)], f"{C.KEY} long, wide string, label int")
    model = dictionary.TargetCodes(inputCols=["wide"], outputCols=["code"]).fit(df)
    assert [r["code"] for r in model.transform(df).collect()] == [0.0, 0.0]
    empty = df.limit(0)
    assert dictionary.TargetCodes(inputCols=["wide"], outputCols=["code"]).fit(empty).transform(df).count() == 2


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_model_is_saved_and_joins_hot_values(spark, tmp_path, broadcast_rows):
    df = frame(spark, wide_rows())
    fit = dictionary.TargetCodes(inputCols=["wide"], outputCols=["code"], broadcastRows=broadcast_rows).fit(df)
    want = brute_codes([(r[1], r[4]) for r in wide_rows()], C.MAX_CODES)
    PipelineModel([fit]).write().save(f"{tmp_path}/model")
    for model in (fit, PipelineModel.load(f"{tmp_path}/model").stages[0]):
        new = df.select(C.KEY, "wide").unionByName(spark.createDataFrame([(-1, "unseen")], f"{C.KEY} long, wide string"))
        for r in model.transform(new).collect():
            assert r["code"] == want.get(r["wide"], 0)


def test_look_up_measures_bytes_before_a_broadcast(spark, monkeypatch):
    from docket.operators import lookup

    df = spark.range(2000).select("id", F.concat(F.lit("v"), F.col("id") % 7).alias("v"))
    table = df.groupBy(F.col("v").alias("value")).agg(F.count("*").alias("rows"), F.collect_list("id").alias("n"))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10)
    got = look_up(df, table, "v", "ids", "id").collect()
    assert len(got) == 2000 and all(r["id"] in r["ids"] for r in got)


def features_of(df, *keep):
    return {tuple(r[k] for k in keep): (r["x"], r["a"]) for r in df.select(*keep, F.col("features").alias("v")).select(*keep, vector_to_array("v").alias("x"), F.lit(0).alias("a")).collect()}


@pytest.mark.parametrize("balance", ["copies", "rows", None])
def test_one_table_gives_what_an_encoder_per_fold_gives(spark, balance):
    # "only" is a value that a single fold holds; the high column has more values than a third of its rows.
    rows = [(i, w, "only" if i == 7 else n, x, y) for i, w, n, x, y in wide_rows(600, 60)]
    df = frame(spark, rows).withColumn("high", F.concat(F.lit("h"), F.floor(F.col(C.KEY) / 2)))
    fit = models.TreeFit(df, "bagged", ROLES, balance, max_nominal=20)
    assert (fit.kinds.high, fit.kinds.wide, fit.kinds.nominal) == (["high"], ["wide"], ["narrow"])
    apart, together = models.fitted_per_fold(fit, df, 4), fit.prepare_folds(df, 4)
    for (a, valid_a), (b, valid_b) in zip(apart, together):
        assert (a.n, a.widest) == (b.n, b.widest)
        assert features_of(a.rows, "key", "label", "weight") == features_of(b.rows, "key", "label", "weight")
        assert a.rows.count() == b.rows.count()
        assert features_of(valid_a, C.KEY, "fold", "label") == features_of(valid_b, C.KEY, "fold", "label")
        # The learner sees the same columns: one nominal with as many values, the others as numbers.
        meta = [p.rows.schema["features"].metadata["ml_attr"]["attrs"] for p in (a, b)]
        assert [len(v["vals"]) for v in meta[0]["nominal"]] == [len(v["vals"]) for v in meta[1]["nominal"]]
        assert len(meta[0]["numeric"]) == len(meta[1]["numeric"])


def test_search_and_out_of_fold_do_not_depend_on_the_table(spark):
    df = frame(spark, wide_rows(600, 60), 3)
    fit = models.TreeFit(df, "bagged", ROLES, max_nominal=20)
    params = {"n_estimators": 5, "num_leaves": 8, "subsample": 0.8, "colsample_bytree": 0.9}

    class Apart:
        learn = staticmethod(fit.learn)
        prepare_folds = staticmethod(lambda df, folds, threads: models.fitted_per_fold(fit, df, folds, threads))

    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(models.out_of_fold(df, fit, params, folds=3)) == rows(models.out_of_fold(df, Apart, params, folds=3))
    tried = [rows(search.search(df, f, "bagged", 2, 3, overrides={"n_estimators": 5})) for f in (fit, Apart)]
    assert tried[0] == tried[1] and len(tried[0]) == 2


def test_selectors_see_codes_of_other_folds(spark):
    """A value that occurs once has no code for its own row, so noise does not look like signal."""
    rows = wide_rows(800, 200)
    raw = spark.createDataFrame([(i, w, n, x, "yes" if y else "no") for i, w, n, x, y in rows], f"{C.KEY} long, wide string, narrow string, x double, {C.TARGET} string")
    codes, bins = binning.selection_frame(raw, ROLES, folds=4, max_nominal=20)
    assert set(bins.nominal) == {"narrow"} and set(bins.numeric) == {"wide", "x"}
    assert codes.count() == 800
    encoded, nominal, numeric = binning.encoded_features(frame(spark, rows), ROLES, max_nominal=20, folds=4)
    fold = {r[C.KEY]: r["fold"] for r in frame(spark, rows).collect()}
    views = {k: brute_codes([(r[1], r[4]) for r in rows if fold[r[0]] != k], C.MAX_CODES) for k in range(1, 5)}
    want = {r[0]: float(views[fold[r[0]]].get(r[1], 0)) for r in rows}
    assert {r[C.KEY]: r["wide"] for r in encoded.collect()} == want


def test_wide_column_trains_and_scores_without_its_values_on_the_driver(spark):
    """Two hundred thousand values: the plan of a scored table holds none of them, and the signal is found."""
    n = 1_000_000
    df = spark.range(n).select(
        F.col("id").alias(C.KEY),
        F.concat(F.lit("value-"), F.pmod(F.xxhash64("id"), F.lit(200_000))).alias("wide"),
        F.lit("a").alias("narrow"),
    )
    df = df.withColumn("label", (F.pmod(F.xxhash64("wide"), F.lit(10)) < 3).cast("int"))
    fit = models.TreeFit(df, "boosted", ROLES)
    assert fit.kinds.wide == ["wide"]
    model = fit(df, {"n_estimators": 2, "num_leaves": 4, "learning_rate": 0.3})
    scored = models.score(model, df, C.KEY, "label")
    assert len(scored._jdf.queryExecution().toString()) < 200_000
    assert scored.where("predict = label").count() / n > 0.95
