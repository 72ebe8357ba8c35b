"""Edge rules on small hand-made tables, against brute force where there is one."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docket.functions.draws import poisson_one, uniform
from docket.operators import contingency, encode, evidence, lookup, metrics, order_stats, profile, resample, screen, search, selection
from docket.operators.attribution import Condition, Explainer, Leaf, base_value, leaf_attributions
from docket.operators.binning import Bins
from docket.operators.folds import stratified_folds
from docket.operators.subset_scores import compact, fold_log_odds, odds_arrays, subset_scores
from docket.schema import Roles, columns_like, conform_columns, conform_types, load_schema, save_schema
from docket.session import scratch_path


def test_roles_go_by_name(spark):
    df = spark.createDataFrame([("a", 1.0, True, 7, "x")], "prova_1 string, resultado_processo double, vt boolean, codigo_processo int, cargo string")
    roles = Roles()
    assert roles.features(df) == ["prova_1", "vt", "cargo"]
    assert roles.categorical(df) == ["prova_1", "vt", "cargo"] and roles.numeric(df) == []
    assert roles.evidence(df) == ["prova_1"]
    assert columns_like(["cargo", "tempo_cargo", "vt"], contains="cargo", without="tempo") == ["cargo"]


def test_booleans_and_nan_are_conformed(spark):
    df = spark.createDataFrame([(True, float("nan")), (None, 1.0), (False, None)], "vt boolean, x double")
    rows = conform_types(df).collect()
    assert [r["vt"] for r in rows] == ["True", None, "False"]
    assert [r["x"] for r in rows] == [None, 1.0, None]


def test_conform_columns_orders_and_refuses(spark):
    df = spark.createDataFrame([(1, "a", 2)], "k int, extra string, x int")
    schema = df.select("x", "k").schema
    assert conform_columns(df, schema).columns == ["x", "k"]
    with pytest.raises(ValueError, match="absent"):
        conform_columns(df.drop("x"), schema)


def test_schema_round_trip(spark):
    schema = spark.range(1).select("id", F.lit("a").alias("b")).schema
    path = scratch_path(spark, "schema")
    save_schema(spark, schema, path)
    assert load_schema(spark, path).names == ["id", "b"]


def test_screen_edges(spark):
    rows = [(None, "INV", "INV", "SIM", "a") for _ in range(4)] + [(None, "INV", "SIM", "NÃO", "b") for _ in range(96)]
    df = spark.createDataFrame(rows, "empty string, marker string, pair string, rare string, odd string")
    rule = {r["feature"]: r["rule"] for r in screen.low_variance(df, df.columns).collect()}
    assert rule == {
        "empty": "all_null",
        "marker": "constant",
        "pair": "one_valid_value",
        "rare": "dominant_value",
        "odd": "dominant_value",
    }


def test_screen_rare_value_needs_yes(spark):
    rows = [("SIM", "x")] * 4 + [("NÃO", "y")] * 4 + [("NÃO", "x")] * 4
    report = screen.low_variance(spark.createDataFrame(rows, "a string, b string"), ["a", "b"])
    assert {r["feature"]: r["rule"] for r in report.collect()} == {"a": "rare_value", "b": "keep"}


def _screen_columns(n=400):
    """Columns at the edges of every rule."""
    some = lambda k, a, b: [a if i < k else b for i in range(n)]
    return {
        "empty": [None] * n,
        "one": ["a"] * n,
        "one_and_null": some(5, None, "a"),
        "marker_only": ["INV"] * n,
        "marker_and_null": some(9, "INV", None),
        "one_valid": some(390, "INV", "a"),
        "at_limit": some(360, "a", "b"),
        "over_limit": some(361, "a", "b"),
        "over_limit_of_valid": [*["INV"] * 200, *["a"] * 181, *["b"] * 19],
        "nulls_before_dominant": [*[None] * 300, *["a"] * 95, *["b"] * 5],
        "half": [*["a"] * 210, *[f"v{i}" for i in range(190)]],
        "rare": [*["SIM"] * 196, *["NÃO"] * 200, *["x"] * 4],
        "not_rare": [*["SIM"] * 195, *["NÃO"] * 200, *["x"] * 5],
        "rare_without_yes": [*["a"] * 196, *["NÃO"] * 200, *["x"] * 4],
        "unique": [f"u{i}" for i in range(n)],
        "unique_with_yes": ["SIM", *[f"u{i}" for i in range(n - 1)]],
        "many_with_yes": [*["SIM"] * 200, *[f"u{i // 5}" for i in range(200)]],
    }


def test_screen_rules_are_those_of_the_full_report(spark):
    table = _screen_columns()
    df = spark.createDataFrame(list(zip(*table.values())), ", ".join(f"{c} string" for c in table)).withColumn("k", F.monotonically_increasing_id())
    want = {r["feature"]: (r["rule"], r["dropped"]) for r in screen.low_variance(df, df.columns).collect()}
    got = {r["feature"]: (r["rule"], r["dropped"]) for r in screen.screen_rules(df, df.columns).collect()}
    assert got == want and {r for r, _ in want.values()} == {"all_null", "constant", "one_valid_value", "dominant_value", "rare_value", "keep"}
    assert screen.screen_rules(df.limit(0), ["one", "k"]).collect() == [("one", "all_null", True), ("k", "all_null", True)]
    assert screen.screen_rules(df, []).collect() == []


def test_screen_counts_values_only_where_a_rule_can_fire(spark, monkeypatch):
    table = _screen_columns()
    df = spark.createDataFrame(list(zip(*table.values())), ", ".join(f"{c} string" for c in table))
    asked = []
    monkeypatch.setattr(screen, "contingency", lambda df, columns, plain=screen.contingency: asked.extend(columns) or plain(df, columns))
    screen.screen_rules(df, df.columns).collect()
    assert asked == ["rare", "not_rare", "many_with_yes"]


def test_duplicate_rows_equal_plain_groups(spark):
    from docket.operators.profile import duplicate_rows

    rows = [(None, None, None)] * 3 + [("a", 0.0, None), ("a", -0.0, None), ("b", float("nan"), 1), ("b", float("nan"), 1)]
    rows += [(f"w{i % 40}" * 50, float(i % 3), i % 2) for i in range(200)] + [(f"only{i}", 1.0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "a string, b double, c int")
    sizes = [r["count"] for r in df.groupBy(*df.columns).count().collect()]
    want = (len(rows), len(sizes), sum(n > 1 for n in sizes), sum(n - 1 for n in sizes))
    assert tuple(duplicate_rows(df).first()) == want
    assert tuple(duplicate_rows(df, ["c"]).first())[:2] == (len(rows), len({r[2] for r in rows}))
    assert tuple(duplicate_rows(df.limit(0)).first()) == (0, 0, 0, 0)


def test_mode_takes_the_lowest_on_ties(spark):
    df = spark.createDataFrame([("SIM",), ("NÃO",), ("INV",), (None,), (None,)], "a string")
    counts = contingency.contingency(df, ["a"])
    assert contingency.modes(counts).first()["mode"] == "INV"
    assert contingency.modes(counts, keep_null=True).first()["mode"] is None


def test_high_card_columns(spark):
    df = spark.range(1000).select(
        (F.col("id") % 301).cast("string").alias("over"),
        (F.col("id") % 300).cast("string").alias("at"),
        F.lit(None).cast("string").alias("empty"),
        F.lit("a").alias("one"),
    )
    assert screen.high_card_columns(df, df.columns) == ["over"]
    assert screen.column_kinds(df, df.columns, max_nominal=300) == (["over"], [], ["at", "empty", "one"])
    assert screen.column_kinds(df, df.columns, max_nominal=299) == (["over"], ["at"], ["empty", "one"])


@pytest.mark.parametrize("rows", [1, 3, 10, 57])
@pytest.mark.parametrize("k", [2, 5, 10])
def test_folds_equal_a_sorted_split(spark, rows, k):
    df = spark.range(rows).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    got = {r["id"]: r["fold"] for r in stratified_folds(df, "id", "label", k).collect()}
    import hashlib

    for label in (0, 1):
        ids = [i for i in range(rows) if int(i % 3 == 0) == label]
        ids.sort(key=lambda i: hashlib.md5(f"{i}:9".encode()).hexdigest())
        size, extra = divmod(len(ids), k)
        want = [fold for fold in range(1, k + 1) for _ in range(size + (fold <= extra))]
        assert [got[i] for i in ids] == want


def test_oversample_evens_the_classes(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 13, 1).when(F.col("id") < 20, 2).otherwise(0).alias("label"))
    counts = {r["label"]: r["n"] for r in resample.oversample(df, "id", "label").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 80, 1: 80, 2: 80}
    copies = [r["copies"] for r in resample.oversample_copies(df, "id", "label").filter("label = 1").collect()]
    assert sorted(set(copies)) == [6, 7] and sum(copies) == 80


def test_oversample_of_one_class_changes_nothing(spark):
    df = spark.range(5).withColumn("label", F.lit(1))
    assert [r["copies"] for r in resample.oversample_copies(df, "id", "label").collect()] == [1] * 5


def test_quantiles_equal_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=501), np.full(400, 0.25), [1e9, -1e9]])
    df = spark.createDataFrame([(float(v), None) for v in x] + [(None, None)], "x double, y double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r["prob"]: r["value"] for r in order_stats.exact_quantiles(df, ["x", "y"], probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(x, probs)))


def test_global_index_is_dense(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("h")).repartition(7)
    rows = order_stats.global_index(df, "h").orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1000))
    assert [r["h"] for r in rows] == sorted(r["h"] for r in rows)


def test_lookup_is_the_same_broadcast_or_split(spark):
    values = ["hot"] * 600 + [f"v{i % 150}" for i in range(300)] + [None] * 100
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    numbers = df.filter("v is not null").groupBy(F.col("v").alias("value")).agg(F.count("*").alias("n"))
    numbers = numbers.filter("value <> 'v3'")
    small = lookup.lookup_number(df, numbers, "v", "x", "id")
    large = lookup.lookup_number(df, numbers, "v", "x", "id", broadcast_rows=0)
    assert sorted(small.collect()) == sorted(large.collect())
    found = {r["v"]: r["x"] for r in large.collect()}
    assert found["hot"] == 600 and found["v1"] == 2 and found["v3"] == 0 and found[None] == 0


def test_frequency_encoder_survives_saving(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "codigo_processo int, c string")
    model = encode.FrequencyEncoder(inputCols=["c"], outputCols=["n"]).fit(train)
    path = scratch_path(spark, "encoder")
    model.write().overwrite().save(path)
    later = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "codigo_processo int, c string")
    rows = encode.FrequencyEncoderModel.load(path).transform(later).orderBy("codigo_processo").collect()
    assert [r["n"] for r in rows] == [2.0, 0.0, 0.0]


def test_numeric_fill_learns_from_training_rows(spark):
    train = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y double")
    later = spark.createDataFrame([(None, None), (float("nan"), 4.0)], "x double, y double")
    fill = lambda s: encode.NumericFill(inputCols=["x", "y"], outputCols=["fx", "fy"], strategy=s).fit(train).transform(later)
    assert [(r["fx"], r["fy"]) for r in fill("mean").collect()] == [(2.0, 0.0), (2.0, 4.0)]
    assert [r["fx"] for r in fill("below_min").collect()] == [0.0, 0.0]


def test_unseen_category_gets_code_zero(spark):
    bins = Bins({"c": ["a", "b"]}, {"x": [1.0, 2.0], "flat": []})
    df = spark.createDataFrame([("a", 0.5, 1.0), ("z", 1.0, None), (None, float("nan"), 2.0), ("b", 9.0, 3.0)], "c string, x double, flat double")
    assert [tuple(r) for r in bins.apply(df).collect()] == [(1, 1, 1), (0, 2, 0), (0, 0, 1), (2, 3, 1)]


def test_metrics_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (1, 1)], "label int, prediction int")
    row = metrics.metrics(metrics.confusion(df)).first()
    assert row["precision_class0"] == 0 and row["recall_class0"] == 0 and row["f1_class0"] == 0
    assert row["macro_f1"] == pytest.approx(0.4)
    assert metrics.MacroF1Evaluator().evaluate(df) == pytest.approx(0.4)


def test_poisson_weights_have_mean_one(spark):
    u = uniform(F.concat(F.col("id").cast("string"), F.lit(":w")))
    row = spark.range(20000).agg(F.avg(poisson_one(u)).alias("m"), F.var_pop(poisson_one(u)).alias("v")).first()
    assert row["m"] == pytest.approx(1, abs=0.03) and row["v"] == pytest.approx(1, abs=0.05)


def _brute_force(leaves, x):
    features = sorted({c.feature for leaf in leaves for c in leaf.conditions})

    def expected(known):
        total = 0.0
        for leaf in leaves:
            weight = leaf.value
            for c in leaf.conditions:
                weight *= float(c.holds(np.array([x[c.feature]]))[0]) if c.feature in known else c.cover
            total += weight
        return total

    p, out = len(features), np.zeros(len(x))
    for f in features:
        rest = [g for g in features if g != f]
        for size in range(p):
            for known in itertools.combinations(rest, size):
                w = math.factorial(size) * math.factorial(p - size - 1) / math.factorial(p)
                out[f] += w * (expected({*known, f}) - expected(set(known)))
    return out


def test_attributions_equal_brute_force_shapley():
    draw = random.Random(5)
    leaves = []
    for _ in range(12):
        chosen = draw.sample(range(4), draw.randint(0, 4))
        conditions = tuple(
            Condition(f, -math.inf, draw.random(), None, draw.random())
            if draw.random() < 0.7
            else Condition(f, -math.inf, math.inf, frozenset({0.0, 1.0}), draw.random())
            for f in chosen
        )
        leaves.append(Leaf(draw.uniform(-1, 1), conditions))
    x = np.array([[0.2, 0.0, 1.0, 0.7], [0.9, 1.0, 0.1, 0.0], [0.5, 0.5, 0.5, 0.5]])
    got = leaf_attributions(leaves, x)
    for row, values in zip(got, x):
        assert row == pytest.approx(_brute_force(leaves, values))
        reached = sum(leaf.value for leaf in leaves if all(c.holds(np.array([values[c.feature]]))[0] for c in leaf.conditions))
        assert row.sum() + base_value(leaves) == pytest.approx(reached)


def _random_leaves(draw, leaves, features, tests):
    out = []
    for _ in range(leaves):
        chosen = draw.sample(range(features), draw.randint(1, tests))
        conditions = [
            Condition(f, -math.inf if draw.random() < 0.5 else draw.gauss(-1, 1), draw.gauss(1, 1) if draw.random() < 0.7 else math.inf, None, draw.uniform(0.1, 0.9))
            for f in chosen
        ]
        out.append(Leaf(draw.gauss(0, 1), tuple(conditions)))
    return out


def test_long_and_short_leaves_agree(monkeypatch):
    """Tables of patterns and the patterns of a batch give the same parts; long leaves equal brute force."""
    draw, rng = random.Random(2), np.random.default_rng(2)
    leaves = _random_leaves(draw, 40, 9, 9)
    assert max(len(leaf.conditions) for leaf in leaves) > Explainer.TABLE_TESTS
    x = rng.normal(size=(50, 9))
    got = leaf_attributions(leaves, x)
    for row, values in zip(got[:3], x):
        assert row == pytest.approx(_brute_force(leaves, values))
    for bound in (0, 20):
        monkeypatch.setattr(Explainer, "TABLE_TESTS", bound)
        assert leaf_attributions(leaves, x) == pytest.approx(got)
    assert leaf_attributions([Leaf(1.0, ())], x) == pytest.approx(np.zeros(x.shape))


def test_parts_of_a_hundred_trees_of_fifty_leaves_add_up():
    draw, rng = random.Random(3), np.random.default_rng(3)
    leaves, x = _random_leaves(draw, 5000, 30, 6), rng.normal(size=(2000, 30))
    parts = leaf_attributions(leaves, x)
    reached = sum(leaf.value * np.prod([c.holds(x[:, c.feature]) for c in leaf.conditions], axis=0) for leaf in leaves)
    assert parts.sum(axis=1) + base_value(leaves) == pytest.approx(reached)


def _published_verdicts(hits, rounds, alpha):
    """The two-step test written out: step-up false discovery rate, then a level for each round."""
    tail = lambda h: sum(math.comb(rounds, k) for k in range(h, rounds + 1)) / 2**rounds
    out = []
    for i, h in enumerate(hits):
        said = "tentative"
        for side, verdict in ((lambda x: tail(x), "confirmed"), (lambda x: tail(rounds - x), "rejected")):
            chances = sorted(side(x) for x in hits)
            lines = [p for k, p in enumerate(chances, 1) if p <= alpha * k / len(chances)]
            if lines and side(h) <= max(lines) and side(h) <= alpha / rounds:
                said = verdict
        out.append(said)
    return out


def test_shadow_verdicts_take_both_steps():
    draw = random.Random(8)
    seen = set()
    for _ in range(200):
        rounds = draw.randint(1, 40)
        hits = [draw.choice([0, rounds, draw.randint(0, rounds)]) for _ in range(draw.randint(1, 12))]
        got = selection.shadow_verdicts(hits, rounds, 0.05)
        assert got == _published_verdicts(hits, rounds, 0.05)
        seen |= set(got)
    assert seen == {"confirmed", "rejected", "tentative"}
    assert selection.shadow_verdicts([], 3, 0.05) == []
    # Five of five hits pass the rate but not the level of the fifth round; eight of eight pass both.
    assert selection.shadow_verdicts([5, 2], 5, 0.05) == ["tentative", "tentative"]
    assert selection.shadow_verdicts([8, 4], 8, 0.05) == ["confirmed", "tentative"]


def test_median_places_ignore_rounds_that_a_feature_missed():
    history = [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.1, "b": 0.6}, {"a": 0.7, "b": 0.2}]
    assert selection._median_ranks(history, ["a", "b", "c", "d"]) == {"a": 1.0, "b": 2.0, "c": 3.0, "d": math.inf}


def test_subset_scores_equal_a_row_by_row_count(spark):
    draw = random.Random(3)
    rows = [(i, draw.randint(0, 1), i % 3 + 1, draw.randint(1, 3), draw.randint(0, 2)) for i in range(200)]
    rows = [(i, y, f, a if draw.random() < 0.5 else 1 + y, b) for i, y, f, a, b in rows]
    codes = spark.createDataFrame(rows, "k int, label int, fold int, b0 int, b1 int")
    bins = Bins({"a": ["x", "y", "z"], "b": ["x", "y"]})
    cells = compact(codes, bins)
    odds = odds_arrays(fold_log_odds(cells, bins, 3), bins, 3)
    got = {r["mask"]: r["macro_f1"] for r in subset_scores(cells, bins, odds, [[0], [1], [0, 1], []]).collect()}
    for m, mask in enumerate([[0], [1], [0, 1], []]):
        per_fold = []
        for fold in (1, 2, 3):
            train = [r for r in rows if r[2] != fold]
            said = []
            for r in (r for r in rows if r[2] == fold):
                s = 0.0
                for j in mask:
                    seen = {q[3 + j] for q in rows}
                    share = lambda y: (sum(q[1] == y and q[3 + j] == r[3 + j] for q in train) + 1) / (sum(q[1] == y for q in train) + len(seen))
                    s += math.log(share(1)) - math.log(share(0))
                said.append((r[1], int(round(s, 9) > 0)))
            f1 = lambda c: 2 * said.count((c, c)) / max(1, sum(y == c for y, _ in said) + sum(p == c for _, p in said))
            per_fold.append((f1(0) + f1(1)) / 2)
        assert got[m] == pytest.approx(sum(per_fold) / 3)


def test_cell_scorer_and_forest_scorer_agree_on_the_best_feature(spark):
    draw = random.Random(4)
    rows = [(i, i % 2, i // 2 % 3 + 1, draw.randint(1, 3), 1 + (i % 2 if draw.random() < 0.9 else draw.randint(0, 1))) for i in range(300)]
    codes = spark.createDataFrame(rows, "k int, label int, fold int, b0 int, b1 int")
    bins = Bins({"noise": ["x", "y", "z"], "signal": ["x", "y"]})
    for scorer in (selection.CellScorer(codes, bins, 3), selection.ForestScorer(codes, bins, 3, trees=3)):
        steps = selection.forward_selection(spark, bins.names, scorer, 5).orderBy("step").collect()
        assert [r["feature"] for r in steps] == ["signal", "noise"]


def test_fewer_features_than_k_drops_none(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feature string, mi double")
    assert selection.bottom_features(scores, "mi", 30).count() == 0
    assert [r["feature"] for r in selection.top_features(scores, "mi", 1).collect()] == ["b"]


def test_vote_protects_evidence_and_job_but_not_tenure(spark):
    names = ["prova_9", "cargo", "tempo_cargo", "salario", "vt"]
    rows = [(s, n) for s in "abc" for n in names[:4]] + [("a", "vt"), ("b", "vt")]
    votes = selection.vote(spark.createDataFrame(rows, "selector string, feature string"))
    assert {r["feature"]: r["removed"] for r in votes.collect()} == {
        "prova_9": False,
        "cargo": False,
        "tempo_cargo": True,
        "salario": True,
        "vt": False,
    }


def test_shadow_copies_keep_each_column_and_break_the_rows(spark):
    codes = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"), F.lit(1.0).alias("weight"), F.col("id").cast("int").alias("b0"))
    blocked = selection.shadow_blocks(codes, "k", ["b0"], 5)
    rows = selection.with_shadows(blocked, ["b0"], 1).collect()
    assert sorted(r["b0"] for r in rows) == sorted(r["s_b0"] for r in rows) == list(range(500))
    assert sum(r["b0"] == r["s_b0"] for r in rows) < 50
    assert {r["b0"]: r["label"] for r in rows} == {i: i % 2 for i in range(500)}


def test_binomial_tail():
    assert selection._binomial_tail(0, 10) == pytest.approx(1)
    assert selection._binomial_tail(10, 10) == pytest.approx(2**-10)


def test_evidence_of_one_row_and_texts(spark):
    parts = [(1, "prova_1", "SIM", 0.5), (2, "prova_1", "NÃO", -0.25), (1, "prova_2", "SIM", 0.1), (2, "prova_2", "SIM", 0.1)]
    totals = evidence.value_totals(spark.createDataFrame(parts, "k int, feature string, value string, contribution double"))
    table = evidence.evidence_table(totals, ["prova_1", "prova_2"])
    assert [tuple(r) for r in table.collect()] == [(1, "prova_1", 0.375, "Positivo")]
    back = evidence.evidence_from_texts(evidence.evidence_texts(table)).collect()
    assert [tuple(r) for r in back] == [(1, "prova_1", 0.375, "Positivo")]


def test_missing_favourable_value_has_no_verdict(spark):
    parts = [(1, "prova_1", None, 0.5), (2, "prova_1", "NÃO", -0.25), (3, "prova_1", "SIM", 0.5)]
    totals = evidence.value_totals(spark.createDataFrame(parts, "k int, feature string, value string, contribution double"))
    table = evidence.evidence_table(totals, ["prova_1"])
    assert table.first()["impacto"] is None
    assert evidence.evidence_from_texts(evidence.evidence_texts(table)).first()["impacto"] is None


def test_trials_stay_within_their_laws(spark):
    from docket import constants as C

    for kind, space in C.SPACES.items():
        drawn = search.trial_table(spark, kind, 50).collect()
        for name, law, low, high, step in space:
            values = [r[name] for r in drawn]
            assert min(values) >= low - 1e-9 and max(values) <= high + 1e-9 and len(set(values)) > 5
            if law == "quniform":
                assert all(v % step == 0 for v in values)


def test_best_trial_takes_the_first_on_ties(spark):
    results = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "trial int, macro_f1 double")
    assert search.best_trial(results).first()["trial"] == 1


def test_duplicates_and_histogram_of_a_flat_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "x double")
    assert tuple(profile.duplicate_rows(df).first()) == (3, 1, 1, 2)
    assert [tuple(r) for r in profile.histogram(df, ["x"]).collect()] == [("x", 0, 1.0, 3)]


@pytest.mark.parametrize("values", [["a"], ["a", "b", "c"], [None]])
def test_a_target_needs_two_classes(spark, values):
    from docket.operators.encode import label_of

    df = spark.createDataFrame([(v,) for v in values], "y string")
    with pytest.raises(ValueError, match="two are needed"):
        label_of(df, "y")
