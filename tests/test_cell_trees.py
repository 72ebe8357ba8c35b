"""Boosted trees grown from cells are the trees that Spark grows from rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from docket.operators import cell_trees, models
from docket.operators.java_draws import RowDraws, XorShift
from docket.session import by_key


def _rows(spark, n, numbers=True, seed=3):
    """Rows with a nominal feature, a strong number of few values, numbers of many values with zeros, and weights."""
    draw = np.random.default_rng(seed)
    label = draw.integers(0, 2, n)
    # One label in five is turned, so that no rule is without exception.
    strong, many = label * 2 + draw.integers(0, 4, n), draw.normal(size=n).round(3) * (draw.random(n) < 0.8)
    name = np.array(list("abcd"))[np.where(draw.random(n) < 0.5, label * 2, draw.integers(0, 4, n))]
    weight = draw.integers(1, 4, n).astype(float)
    label = np.where(draw.random(n) < 0.2, 1 - label, label)
    columns = (range(n), label, weight, strong.astype(float), many if numbers else many * 0.0, name)
    made = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in zip(*columns)]
    df = spark.createDataFrame(made, "key long, label int, weight double, strong double, many double, name string")
    df = StringIndexer(inputCol="name", outputCol="code", stringOrderType="alphabetAsc").fit(df).transform(df)
    vectors = VectorAssembler(inputCols=["code", "strong", "many"], outputCol="features").transform(df)
    return vectors.select("key", "label", "weight", "features").localCheckpoint()


def _nodes(model):
    out = []
    for tree in model.trees:
        nodes, waiting = [], [tree._java_obj.rootNode()]
        while waiting:
            node = waiting.pop()
            # Whether rows of one label are parted further depends on rounding, and says nothing.
            pure = abs(node.impurity()) < 1e-9 or node.impurity() == -1.0
            nodes.append((round(node.prediction(), 8), 0.0 if pure else round(node.impurity(), 8)))
            if node.subtreeDepth() and not pure:
                split = node.split()
                nodes[-1] += (split.featureIndex(), tuple(split.leftCategories()) if "Categorical" in split.getClass().getName() else split.threshold())
                waiting += [node.rightChild(), node.leftChild()]
        out.append(nodes)
    return out


def test_rows_are_drawn_from_sparks_numbers():
    seeds, rate = [9, 10, -5], 0.7
    draws = RowDraws(seeds, rate)
    got = np.concatenate([draws.take(n) for n in (1, 31, 32, 33, 100)])
    streams = [XorShift(s) for s in seeds]
    assert got.tolist() == [[s.next_double() < rate for s in streams] for _ in range(197)]


@pytest.mark.parametrize(
    "params",
    [
        {"maxIter": 6, "maxDepth": 3, "subsamplingRate": 0.8, "stepSize": 0.1},
        {"maxIter": 4, "maxDepth": 5, "subsamplingRate": 0.5, "featureSubsetStrategy": "0.5", "minInstancesPerNode": 9, "minInfoGain": 1e-4},
        {"maxIter": 3, "maxDepth": 4},
    ],
)
def test_trees_are_sparks(spark, params, monkeypatch):
    monkeypatch.setattr(cell_trees, "TREES_A_LONG_PASS", 2)
    n = 21_000
    rows = _rows(spark, n)
    learner = GBTClassifier(weightCol="weight", seed=9, **params)
    want = learner.fit(by_key(rows, n, "key"))
    near = cell_trees.fit_boosted(learner, rows, n)
    far = cell_trees.fit_boosted(learner, rows, n, kept_draws=0)
    assert _nodes(near) == _nodes(want) == _nodes(far)
    assert near.treeWeights == want.treeWeights and near.numFeatures == want.numFeatures
    p = lambda m: [r[0] for r in m.transform(rows).orderBy("key").select(F.col("probability")).head(200)]
    assert np.allclose(p(near), p(want), atol=1e-9)


def test_a_boosted_fit_passes_over_cells_and_not_over_rows(spark, monkeypatch):
    n, seen = 4000, []
    rows = _rows(spark, n, numbers=False)
    sums = cell_trees.Tree.sums
    monkeypatch.setattr(cell_trees.Tree, "sums", lambda tree, cells, *a: seen.append(len(cells.label)) or sums(tree, cells, *a))
    learner = models.classifier("boosted", {"n_estimators": 3, "num_leaves": 8, "subsample": 0.8}, None, 32)
    cell_trees.fit_boosted(learner, rows, n)
    cells = rows.select("label", "weight", "features").distinct().count()
    assert 0 < cells < 200 and len(seen) <= 9 and max(seen) == cells
