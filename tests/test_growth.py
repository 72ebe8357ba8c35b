"""What jobs send, keep and read again as tables grow."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from docket.checks import queries
from docket.operators import cell_forest, selection
from docket.operators.attribution import Condition, Explainer, Leaf, base_value, leaf_attributions, log_odds_attributions
from docket.operators.binning import Bins
from docket.session import partitions_of, side_by_side


def test_learners_partitions_stay_few():
    assert [partitions_of(n) for n in (0, 1, 20_000, 20_001, 150_000)] == [1, 1, 1, 2, 8]
    assert [partitions_of(n) for n in (900_000, 9_000_000, 54_000_000)] == [12, 36, 216]


def test_large_learners_run_one_after_another(spark):
    assert side_by_side(spark, 8, 15_000) == 8 and side_by_side(spark, 1, 15_000) == 1
    assert side_by_side(spark, 8, 9_000_000) == 1


def test_blocks_of_shadows_are_dealt_once_for_all_rounds(spark, monkeypatch):
    rows = [(i, i % 2, i % 3 + 1, i % 2 + 1, i * 7 % 5) for i in range(400)]
    codes = spark.createDataFrame(rows, f"{queries.C.KEY} long, label int, fold int, b0 int, b1 int")
    dealt, deal = [], type(codes).repartition
    monkeypatch.setattr(type(codes), "repartition", lambda df, *a: dealt.append(a) or deal(df, *a))
    bins = Bins({"signal": ["a", "b"], "noise": list("abcde")})
    got = selection.shadow_selection(codes, bins, rounds=3, trees=5, block_rows=100).collect()
    assert len(dealt) == 1
    assert [r["feature"] for r in got] == ["signal", "noise"] and got[0]["hits"] == 3


def test_frequent_values_of_a_large_table_are_not_shuffled(spark):
    names = ["flag", "name"]
    rows = [(i, i % 2, None if i % 4 else "SIM", f"n{i // 2}") for i in range(3000)] + [(7, 0, "SIM", None)]
    df = spark.createDataFrame(rows, "k long, label int, flag string, name string")
    small, large = (log_odds_attributions(df, names, "k", broadcast_rows=n) for n in (500_000, 10))
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    assert large.count() == 2 * len(rows)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("strategy=broadcast") == 2


def test_case_table_is_built_once_for_its_labels(spark, folder, monkeypatch):
    queries.forget()
    seen, label_of = [], queries.encode.label_of
    monkeypatch.setattr(queries.encode, "label_of", lambda df, *a: seen.append(df) or label_of(df, *a))
    queries.labelled(spark, folder)
    queries.forget()
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_like_rows_are_explained_once(monkeypatch):
    conditions = [Condition(0, -math.inf, 2.0, None, 0.5), Condition(0, 2.0, math.inf, None, 0.5), Condition(1, -math.inf, math.inf, frozenset({1.0}), 0.25)]
    leaves = [Leaf(1.0, (conditions[0], conditions[2])), Leaf(-2.0, (conditions[1],)), Leaf(0.5, (conditions[2], conditions[1]))]
    cells = np.array([(a, b) for a in (-math.inf, 1.0, 2.0, 2.5, math.inf, math.nan) for b in (0.0, 1.0, 1.5, math.nan)])
    alone = [leaf_attributions(leaves, x[None, :])[0] for x in cells]
    tested, holds = [0], Condition.holds
    monkeypatch.setattr(Condition, "holds", lambda c, values: tested.__setitem__(0, tested[0] + len(values)) or holds(c, values))
    which = np.random.default_rng(3).integers(0, len(cells), 20_000)
    explainer = Explainer(leaves)
    for some in (which[:12_000], which[12_000:]):
        assert np.array_equal(explainer(cells[some]), np.array(alone)[some])
    assert tested[0] < 1000
    monkeypatch.setattr(Explainer, "KEPT_CELLS", 3)
    assert np.array_equal(Explainer(leaves)(cells[which]), np.array(alone)[which])
    for x, parts in zip(cells, alone):
        reached = sum(leaf.value for leaf in leaves if all(holds(c, x[c.feature : c.feature + 1])[0] for c in leaf.conditions))
        assert abs(parts.sum() + base_value(leaves) - reached) < 1e-12


def _coded(n, seed=5):
    """Rows ``(label, fold, b0, b1, b2)`` with a weak, a strong and a useless feature of 4, 6 and 40 codes."""
    draw = np.random.default_rng(seed)
    label = draw.integers(0, 2, n)
    strong = np.where(draw.random(n) < 0.7, label * 3, 0) + draw.integers(0, 3, n)
    columns = (label, draw.integers(1, 4, n), np.where(draw.random(n) < 0.3, label, draw.integers(0, 4, n)), strong, draw.integers(0, 40, n))
    return [tuple(map(int, r)) for r in zip(*columns)], "label int, fold int, b0 int, b1 int, b2 int"


BINS = Bins({"weak": list("abc"), "strong": list("abcde"), "useless": [str(i) for i in range(39)]})


def test_forests_pass_over_cells_and_not_over_rows(spark, monkeypatch):
    rows, schema = _coded(4000)
    seen, staged = [], selection.staged
    monkeypatch.setattr(selection, "staged", lambda df, name: seen.append(staged(df, name)) or seen[-1])
    codes = spark.createDataFrame(rows, schema)
    scorer = selection.ForestScorer(codes, BINS, 3, trees=4, threads=1)
    scores = scorer([[0], [1], []])
    assert [t.count() for t in seen[1:]] == [len({(r[0], r[1], r[c]) for r in rows}) for c in (2, 3)]
    assert 0.5 < scores[0] < scores[1] < 1 and scores[2] == 0.0
    # Draws, and so scores, change neither with the order nor with the partitions of the rows.
    assert selection.ForestScorer(spark.createDataFrame(rows[::-1], schema).repartition(3), BINS, 3, trees=4)([[0], [1], []]) == scores


def test_cells_are_drawn_as_their_rows_would_be(spark):
    codes = spark.range(40_000).select(F.lit(1).alias("fold"), F.lit(0).alias("label"), (F.col("id") % 400).cast("int").alias("b0"))
    cells = cell_forest.drawn_cells(codes, ["b0"], 20).toPandas()
    times = cells[[f"t{t}" for t in range(20)]].to_numpy()
    # A sum of a hundred Poisson(1): mean and variance are a hundred.
    assert (cells["n"] == 100).all() and abs(times.mean() - 100) < 1 and 90 < times.var() < 110
    assert len({tuple(r) for r in times.tolist()}) == 400 and len({tuple(r) for r in times.T.tolist()}) == 20


@pytest.mark.parametrize("mask", [[0], [2], [0, 1], [0, 1, 2]])
def test_a_tree_from_cells_is_sparks_tree(spark, mask):
    rows, schema = _coded(3000)
    codes = spark.createDataFrame(rows, schema).cache()
    columns = [f"b{i}" for i in mask]
    ones = sum(r[0] for r in rows)
    weights = [len(rows) / 2 / (len(rows) - ones), len(rows) / 2 / ones]
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(codes)
    vectors = vectors.withColumn("weight", F.when(F.col("label") == 1, weights[1]).otherwise(weights[0]))
    tree = RandomForestClassifier(numTrees=1, bootstrap=False, maxDepth=queries.C.SELECTOR_DEPTH, weightCol="weight", seed=1)
    want = {}
    for fold in (1, 2, 3):
        said = tree.fit(vectors.filter(F.col("fold") != fold)).transform(vectors.filter(F.col("fold") == fold))
        for r in said.groupBy("label", F.col("prediction").cast("int").alias("p")).count().collect():
            want[fold, r["label"], r["p"]] = r["count"]
    cells = codes.groupBy("fold", "label", *columns).agg(F.count("*").alias("n")).withColumn("t0", F.col("n")).cache()
    counts = cell_forest.code_counts(codes, columns, 3)
    forest = cell_forest.CellForest([counts[c] for c in columns], weights, 3, 1).grow(cells, columns)
    assert {(r["fold"], r["label"], r["prediction"]): r["n"] for r in forest.confusions(cells, columns).collect()} == want
