"""Exact quantiles under skew: no task ranks more rows than stated."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docket.operators import order_stats
from docket.operators.folds import stratified_folds

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def at_rank(values, p):
    values = sorted(values)
    return values[max(math.ceil(len(values) * p), 1) - 1]


def columns(n=20_000):
    draw = random.Random(4)
    return {
        # A third of the rows hold one value, among very many others.
        "hot": [5.0 if i % 3 == 0 else draw.gauss(5, 1e-6 if i % 5 else 1e6) for i in range(n)],
        "unique": [float((i * 7919) % n) for i in range(n)],
        "wide": [draw.choice([-1, 1]) * 10 ** draw.uniform(-300, 300) for _ in range(n)],
        "flat": [1.0] * n,
        "two": [float(i % 2) for i in range(n)],
        "few": [None if i % 4 else float(i) for i in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("largest", [1, 50, 10**6])
def test_quantiles_are_exact_at_any_bound(spark, largest):
    table = columns()
    df = spark.createDataFrame(list(zip(*table.values())), ", ".join(f"{c} double" for c in table))
    got = order_stats.exact_quantiles(df, list(table), PROBS, interpolate=False, buckets=16, largest=largest).collect()
    assert {r["feature"] for r in got} == set(table) - {"none"}
    for r in got:
        assert r["value"] == at_rank([v for v in table[r["feature"]] if v is not None], r["prob"])


def test_no_task_ranks_more_rows_than_stated(spark, monkeypatch):
    """With a bound of 50 rows, one hot value and 10^5 distinct ones, every ranked spot is small."""
    sizes = []

    def watched(keyed, by, wanted, plain=order_stats._spots):
        out = plain(keyed, by, wanted)
        sizes.append(max(r["n"] for r in out if r["low"] != r["high"]) if any(r["low"] != r["high"] for r in out) else 0)
        return out

    monkeypatch.setattr(order_stats, "_spots", watched)
    df = spark.range(150_000).select(F.when(F.col("id") % 3 == 0, 77.5).otherwise(F.col("id").cast("double")).alias("x"))
    got = order_stats.exact_quantiles(df, ["x"], [0.5], interpolate=False, buckets=4, largest=50).collect()
    values = [77.5 if i % 3 == 0 else float(i) for i in range(150_000)]
    assert got[0]["value"] == at_rank(values, 0.5)
    assert sizes[0] > 50 and len(sizes) > 1 and sizes[-1] <= 50


def test_hash_ranks_are_refined_by_digits(spark, monkeypatch):
    df = spark.range(5000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    want = sorted(map(tuple, stratified_folds(df, "id", "label", 7).collect()))
    monkeypatch.setattr(order_stats, "HASH_DIGITS", 1)
    few = lambda *a, **k: order_stats.order_statistics(*a, order_stats.finer_digits, 3)
    order = F.md5(F.col("id").cast("string"))
    found = few(df, F.col("label"), order, F.substring(order, 1, 1), lambda total: F.array(F.lit(1).cast("bigint"), F.floor(total / 2), total))
    import hashlib

    texts = {y: sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(5000) if i % 2 == y) for y in (0, 1)}
    assert {(r["g"], r["rank"], r["v"]) for r in found.collect()} == {(y, k, texts[y][k - 1]) for y in (0, 1) for k in (1, 1250, 2500)}
    assert sorted(map(tuple, stratified_folds(df, "id", "label", 7).collect())) == want


def test_empty_input_has_no_quantiles(spark):
    df = spark.createDataFrame([], "x double")
    assert order_stats.exact_quantiles(df, ["x"], [0.5]).collect() == []
