import math

import numpy as np
from pyspark.sql import functions as F

from docket.llm import topk


def brute(rows, k):
    sound = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sound:
        if i % 3 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in sound if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def test_equals_brute_force_with_ties_nulls_and_odd_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 40).tolist()) for i in range(150)]
    rows += [(200 + i, [1.0] * 40) for i in range(30)] + [(300, None), (303, []), (306, [1.0, None]), (309, [math.nan] * 40)]
    rows += [(312, [math.inf] * 40), (None, [1.0] * 40), (315, [1.0, 2.0]), (316, [0.5, 2.0]), (318, [1.0] * 7)]
    data = spark.createDataFrame([(i, v, "r") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    v = data.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    got = topk.exact_top_k(v, v.where("vec_id % 3 = 0"), 5, group_rows=40).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5)


def test_empty_table(spark):
    v = spark.createDataFrame([], "vec_id long, vector array<double>")
    assert topk.exact_top_k(v, v, 5).collect() == []
