"""Every operator as a query over a data folder.

Derived tables that several queries read are written once per session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Imputer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docket import constants as C
from docket.functions.draws import uniform
from docket.operators import (
    additive,
    attribution,
    binning,
    contingency,
    dictionary,
    encode,
    evidence,
    folds,
    metrics,
    models,
    order_stats,
    profile,
    resample,
    screen,
    search,
    selection,
    subset_scores,
)
from docket.plans.explore import explore
from docket.plans.prepare import SelectorSettings, prepare
from docket.plans.score import score_file, score_future
from docket.plans.train import TrainSettings, attributions, fitter, train, training_frame
from docket.schema import Roles, columns_like, conform_columns, conform_types
from docket.session import scratch_path, staged
from docket.sources import ledger, tables
from docket.sources.cases import cases

Query = Callable[[SparkSession, str], DataFrame]
ROLES = Roles()
KEEP = 4
_derived: dict[tuple, object] = {}


def forget() -> None:
    """Drop the derived tables, so the next query makes its own."""
    _derived.clear()


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    place = (spark.sparkContext.applicationId, folder, name)
    if place not in _derived:
        _derived[place] = make()
    return _derived[place]


def case_table(spark: SparkSession, folder: str) -> DataFrame:
    return conform_types(cases(spark, folder))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return _once(
        spark, folder, "labelled", lambda: encode.label_of(staged(case_table(spark, folder), "cases"), C.TARGET)
    )


def screened(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "screened", lambda: screen.drop_low_variance(labelled(spark, folder))[0])


def coded(spark: SparkSession, folder: str) -> tuple[DataFrame, binning.Bins]:
    return _once(spark, folder, "coded", lambda: binning.selection_frame(screened(spark, folder).drop("label")))


def scorer(spark: SparkSession, folder: str) -> selection.CellScorer:
    return _once(spark, folder, "scorer", lambda: selection.CellScorer(*coded(spark, folder)))


def flag_parts(spark: SparkSession, folder: str) -> DataFrame:
    df = labelled(spark, folder)
    return attribution.log_odds_attributions(df, ROLES.features(df))


def flag_totals(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.value_totals(flag_parts(spark, folder))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers with nulls as doubles, which both engines hand over alike."""
    return df.withColumn("tempo_cargo", F.col("tempo_cargo").cast("double"))


def ruled(spark: SparkSession, folder: str) -> DataFrame:
    """A plain rule as prediction, to have something to measure."""
    return labelled(spark, folder).withColumn("prediction", (F.col("prova_1") == C.YES).cast("int"))


# Sources and sinks


def scan_raw(spark, folder):
    df = case_table(spark, folder)
    path = scratch_path(spark, "raw")
    tables.write_csv(df, path)
    return plain(tables.read_raw(spark, path, df.schema))


def scan_prepared(spark, folder):
    path = scratch_path(spark, "prepared")
    tables.write_prepared(screened(spark, folder).drop("label"), path)
    return plain(tables.read_prepared(spark, path))


def conform_schema(spark, folder):
    df = case_table(spark, folder)
    wanted = T.StructType([df.schema[c] for c in (C.KEY, "prova_3", "cargo", "tempo_cargo")])
    return plain(conform_columns(df, wanted))


def scores_round_trip(spark, folder):
    scored = ruled(spark, folder).select(
        C.KEY, "cargo", F.col("prediction").alias("predict"), F.lit(0.5).alias("probability")
    )
    path = scratch_path(spark, "scores")
    proof = evidence.evidence_table(flag_totals(spark, folder), ROLES.evidence(labelled(spark, folder)))
    tables.write_scores(scored, proof, path)
    return tables.read_raw(spark, f"{path}/predictions", scored.schema)


def model_lookup(spark, folder):
    stages = tables.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("stage"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_orderdate").alias("promoted_at"),
    )
    return ledger.latest_models(stages)


def run_names(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("run"), ledger.run_name(F.col("o_orderstatus"), F.col("o_orderdate")).alias("run_name")
    )


def preview(spark, folder):
    return plain(tables.preview(case_table(spark, folder), C.KEY))


def table_shape(spark, folder):
    df = case_table(spark, folder)
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


# Projections and filters


def screened_table(spark, folder):
    return plain(screened(spark, folder).drop("label"))


def column_roles(spark, folder):
    df = case_table(spark, folder)
    role = {ROLES.key: "key", ROLES.target: "target"}
    role |= {c: "numeric" for c in ROLES.numeric(df)} | {c: "categorical" for c in ROLES.categorical(df)}
    evidence_columns = ROLES.evidence(df)
    plain = columns_like(df.columns, without=C.JOB_TITLE)
    facts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "feature", "n_known")
    names = F.create_map(*[F.lit(x) for pair in role.items() for x in pair])
    return facts.select(
        "feature",
        names[F.col("feature")].alias("role"),
        F.col("feature").isin(evidence_columns).alias("is_evidence"),
        (~F.col("feature").isin(plain)).alias("is_job"),
        "n_known",
    )


def cast_types(spark, folder):
    return case_table(spark, folder).select(
        C.KEY, "vt", F.col("tempo_cargo").cast("double").alias("tempo"), F.col("tempo_cargo").cast("string").alias("tempo_text")
    )


def packed_features(spark, folder):
    df = case_table(spark, folder)
    packed = df.select(C.KEY, F.struct(*ROLES.features(df)).alias("packed"))
    return plain(packed.select(C.KEY, "packed.cargo", "packed.vt", "packed.prova_1", "packed.tempo_cargo"))


def unpacked_result(spark, folder):
    df = case_table(spark, folder)
    result = F.array("prova_1", "prova_2", "prova_7")
    spots = [F.get(F.col("result"), i).alias(f"r{i}") for i in range(4)]
    return df.select(C.KEY, result.alias("result")).select(C.KEY, *spots)


def valid_values(spark, folder):
    return case_table(spark, folder).filter(F.col("prova_1") != C.INVALID).select(C.KEY, "prova_1")


def value_present(spark, folder):
    df = case_table(spark, folder)
    columns = [c for c in df.columns if c != C.KEY]
    a = screen.columns_with_value(df, columns, C.INVALID).withColumn("marker", F.lit(C.INVALID))
    return a.unionByName(screen.columns_with_value(df, columns, C.YES).withColumn("marker", F.lit(C.YES)))


def invalid_marker_columns(spark, folder):
    df = case_table(spark, folder)
    return screen.columns_with_value(df, df.columns).filter("present").select("feature")


def fill_missing(spark, folder):
    df = case_table(spark, folder).withColumn("tempo_cargo", F.col("tempo_cargo").cast("double"))
    centre = order_stats.exact_quantiles(df, ["tempo_cargo"], [0.5]).select(F.col("value").alias("m"), F.lit(1).alias("one"))
    filled = Imputer(strategy="mean", inputCols=["ultima_remuneracao"], outputCols=["remuneracao"]).fit(df).transform(df)
    with_median = filled.withColumn("one", F.lit(1)).join(F.broadcast(centre), "one")
    return rounded(
        with_median.select(
            C.KEY,
            F.coalesce("prova_7", F.lit(C.MISSING)).alias("prova_7"),
            "remuneracao",
            F.coalesce("tempo_cargo", "m").alias("tempo"),
        ),
        "remuneracao",
        "tempo",
    )


# Counts


def class_balance(spark, folder):
    return contingency.value_counts(case_table(spark, folder), C.TARGET)


def counts_by_outcome(spark, folder):
    df = case_table(spark, folder)
    return contingency.contingency(df, ROLES.categorical(df), [C.TARGET])


def distinct_values(spark, folder):
    df = case_table(spark, folder)
    return contingency.distinct_counts(contingency.contingency(df, df.columns))


def column_modes(spark, folder):
    df = case_table(spark, folder)
    return contingency.modes(contingency.contingency(df, ROLES.categorical(df)))


def column_centres(spark, folder):
    df = case_table(spark, folder)
    columns = ROLES.numeric(df)
    medians = order_stats.exact_quantiles(df, columns, [0.5]).select("feature", F.col("value").alias("median"))
    means = profile.numeric_moments(df, columns).select("feature", "mean")
    return rounded(means.join(medians, "feature"), "mean", "median")


def crosstab_outcome(spark, folder):
    return contingency.crosstab(case_table(spark, folder), "prova_1", C.TARGET)


def profile_numeric(spark, folder):
    df = case_table(spark, folder)
    out = profile.numeric_profile(df, ROLES.numeric(df))
    return rounded(out, *[f.name for f in out.schema if isinstance(f.dataType, T.DoubleType)], digits=4)


def profile_categorical(spark, folder):
    df = case_table(spark, folder)
    return rounded(profile.categorical_profile(df, ROLES.categorical(df)), "mean_length")


def frequent_values(spark, folder):
    df = case_table(spark, folder)
    return profile.frequent_values(df, ROLES.categorical(df), 10)


def histogram(spark, folder):
    df = case_table(spark, folder)
    return rounded(profile.histogram(df, ROLES.numeric(df)), "bin_start")


def duplicate_rows(spark, folder):
    df = case_table(spark, folder)
    return profile.duplicate_rows(df, df.columns)


# Screening


def low_variance_screen(spark, folder):
    df = case_table(spark, folder)
    return rounded(screen.low_variance(df, ROLES.categorical(df)), "top_share")


def low_variance_all_columns(spark, folder):
    df = case_table(spark, folder)
    return rounded(screen.low_variance(df, df.columns), "top_share")


def screen_rules(spark, folder):
    """The verdicts that the jobs act on, for every column of the case table."""
    df = case_table(spark, folder)
    return screen.screen_rules(df, df.columns)


def high_cardinality(spark, folder):
    df = case_table(spark, folder)
    return rounded(screen.high_cardinality(df, ROLES.categorical(df)), "ratio")


def explore_job(spark, folder):
    """The exploration job; its screening report of all columns."""
    reports, _ = explore(cases(spark, folder))
    return rounded(reports["screen"], "top_share")


def high_card_columns(spark, folder):
    """The columns that the jobs encode by frequency."""
    df = case_table(spark, folder)
    columns = ROLES.categorical(df)
    high = screen.high_card_columns(df, columns)
    return spark.createDataFrame([(c, c in high) for c in columns], "feature string, high_card boolean")


def future_from_csv(spark, folder):
    """Future cases as a file spells them, conformed to the training columns."""
    raw = cases(spark, folder)
    path = scratch_path(spark, "future")
    tables.write_csv(raw.where(F.col(C.KEY) % 5 == 0), path)
    wanted = conform_types(raw).drop(C.TARGET).schema
    return plain(tables.read_future(spark, path, wanted, raw_schema=raw.schema))


def feature_difference(spark, folder):
    df = case_table(spark, folder)
    report = screen.low_variance(df, ROLES.categorical(df))
    return report.select("feature").join(report.filter("dropped").select("feature"), "feature", "left_anti")


# Encoding and sampling


def label_encode(spark, folder):
    df = case_table(spark, folder)
    return encode.code_table(df, [*ROLES.categorical(df), C.TARGET])


def category_codes(spark, folder):
    df = case_table(spark, folder)
    return encode.category_codes(df, ROLES.categorical(df))


def frequency_encode(spark, folder):
    df = case_table(spark, folder)
    encoder = encode.FrequencyEncoder(inputCols=["matricula", "prova_7"], outputCols=["matricula_n", "prova_7_n"])
    return encoder.fit(df).transform(df).select(C.KEY, "matricula_n", "prova_7_n")


def mean_impute(spark, folder):
    df = case_table(spark, folder)
    names = ROLES.numeric(df)
    fill = encode.NumericFill(inputCols=names, outputCols=[f"{c}_filled" for c in names], strategy="mean")
    return rounded(fill.fit(df).transform(df).select(C.KEY, *[f"{c}_filled" for c in names]), *[f"{c}_filled" for c in names])


def feature_codes(spark, folder):
    codes, bins = coded(spark, folder)
    return codes.select(C.KEY, *[F.col(c).alias(n) for c, n in zip(bins.columns, bins.names)])


def class_weights(spark, folder):
    return rounded(resample.class_weights(labelled(spark, folder), "label"), "weight")


def stratified_folds(spark, folder):
    ten = folds.stratified_folds(labelled(spark, folder), C.KEY, "label", C.TRAIN_FOLDS)
    return folds.stratified_folds(ten, C.KEY, "label", C.SELECTOR_FOLDS, name="fold5").select(C.KEY, "label", "fold", "fold5")


def oversample(spark, folder):
    return resample.oversample(labelled(spark, folder), C.KEY, "label").select(C.KEY, "label", "copy")


def oversample_labels(spark, folder):
    quality = tables.table(spark, folder, "labels").join(tables.table(spark, folder, "documents"), "doc_id")
    rows = quality.select("doc_id", "lang", "quality")
    return resample.oversample_copies(rows, "doc_id", "quality")


def dummy_baseline(spark, folder):
    said = resample.dummy_predictions(labelled(spark, folder), C.KEY, "label")
    return rounded(metrics.classification_report(metrics.confusion(said)), "precision", "recall", "f1")


# Metrics


def confusion_metrics(spark, folder):
    out = metrics.metrics(metrics.confusion(ruled(spark, folder)))
    return rounded(out, *out.columns)


def macro_f1(spark, folder):
    split = folds.stratified_folds(ruled(spark, folder), C.KEY, "label", C.SELECTOR_FOLDS)
    counts = metrics.confusion(split, by=("fold",)).persist()
    pooled = metrics.macro_f1(counts).withColumn("average", F.lit("pooled"))
    return rounded(
        pooled.unionByName(metrics.macro_f1(counts, average="fold").withColumn("average", F.lit("fold"))), "macro_f1"
    )


def classification_report(spark, folder):
    return rounded(metrics.classification_report(metrics.confusion(ruled(spark, folder))), "precision", "recall", "f1")


# Selection


def _named(table: DataFrame, bins: binning.Bins) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in zip(bins.columns, bins.names) for x in pair])
    return table.withColumn("feature", names[F.col("feature")])


def _information(spark, folder):
    codes, bins = coded(spark, folder)
    return _named(selection.mutual_information(codes, bins.columns), bins)


def mutual_information(spark, folder):
    return rounded(_information(spark, folder), "mi")


def top_k_features(spark, folder):
    return rounded(selection.top_features(_information(spark, folder), "mi", KEEP), "mi")


def bottom_features(spark, folder):
    return rounded(selection.bottom_features(_information(spark, folder), "mi", KEEP), "mi")


def selector_vote(spark, folder):
    df = labelled(spark, folder)
    counts = screen.low_variance(df, ROLES.categorical(df))
    known = df.agg(*[F.count(c).cast("double").alias(c) for c in ROLES.features(df)]).unpivot(
        [], ROLES.features(df), "feature", "known"
    )
    ranks = (
        ("information", _information(spark, folder), "mi"),
        ("importance", evidence.global_importance(flag_totals(spark, folder)), "importance"),
        ("spread", counts.select("feature", (-F.col("top_share")).alias("spread")), "spread"),
        ("known", known, "known"),
    )
    drops = None
    for name, table, score in ranks:
        part = selection.bottom_features(table.drop("place"), score, KEEP).select(F.lit(name).alias("selector"), "feature")
        drops = part if drops is None else drops.unionByName(part)
    return selection.vote(drops)


def _masks(names):
    return [[i] for i in range(len(names))] + [list(range(len(names)))]


def subset_score_table(spark, folder):
    s = scorer(spark, folder)
    scored = subset_scores.subset_scores(s.cells, s.bins, s.odds, _masks(s.bins.names))
    names = F.array(*[F.lit(n) for n in [*s.bins.names, "all"]])
    return rounded(scored.select(F.get(names, F.col("mask")).alias("subset"), "macro_f1"), "macro_f1")


def forward_step(spark, folder):
    s = scorer(spark, folder)
    return rounded(selection.forward_selection(spark, s.bins.names, s, 1), "macro_f1")


def forward_selection(spark, folder):
    s = scorer(spark, folder)
    return rounded(selection.forward_selection(spark, s.bins.names, s, KEEP), "macro_f1")


def forest_forward_step(spark, folder):
    """The first step of forward selection with a forest for each candidate and fold."""
    codes, bins = coded(spark, folder)
    return selection.forward_selection(spark, bins.names, selection.ForestScorer(codes, bins), 1)


def genetic_selection(spark, folder):
    s = scorer(spark, folder)
    return selection.genetic_selection(spark, s.bins.names, s, KEEP)


def boruta_ranking(spark, folder):
    codes, bins = coded(spark, folder)
    return selection.shadow_selection(codes, bins, rounds=20, trees=30)


# Models


def trial_tables(spark, folder):
    trials = tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("trial"))
    out = None
    for kind, space in C.SPACES.items():
        drawn = search.draw_parameters(trials, space)
        part = drawn.unpivot(["trial"], [p[0] for p in space], "parameter", "value").withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return rounded(out, "value")


def best_trial(spark, folder):
    results = tables.table(spark, folder, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_partkey").alias("trial"), F.col("p_retailprice").alias("macro_f1")
    )
    return search.best_trial(results, by=("brand",))


def naive_scores(spark, folder):
    margin = F.sum("contribution")
    p1 = 1.0 / (1.0 + F.exp(-F.round(margin, 9)))
    return (
        flag_parts(spark, folder)
        .groupBy(C.KEY)
        .agg(p1.alias("p1"))
        .select(
            C.KEY,
            (F.col("p1") > 0.5).cast("int").alias("predict"),
            F.round(F.greatest(F.col("p1"), 1 - F.col("p1")), 6).alias("probability"),
        )
    )


def _tree_scores(kind, params):
    def run(spark, folder):
        df = screened(spark, folder)
        return models.score(models.TreeFit(df, kind)(df, params), df, C.KEY, "cargo")

    return run


# Within the search laws; trees, rounds and bags at their lower bounds.
BOOSTED = {"n_estimators": 100, "num_leaves": 8, "learning_rate": 0.1, "subsample": 0.8}
BAGGED = {"n_estimators": 50, "num_leaves": 16, "subsample": 0.8, "colsample_bytree": 0.6}
ADDITIVE = {"max_rounds": 10, "interactions": 2, "outer_bags": 8, "learning_rate": 0.3, "max_bins": 16}


def additive_round1(spark, folder):
    codes, bins = coded(spark, folder)
    return rounded(additive.first_round(codes, bins), "score")


def additive_scores(spark, folder):
    df = screened(spark, folder)
    model = additive.AdditiveFit(df, sweep="round")(df, ADDITIVE)
    return models.score(model, df, C.KEY, "cargo")


def folded(spark, folder):
    """The training table with ten folds."""
    return _once(spark, folder, "folded", lambda: training_frame(screened(spark, folder).drop("label"), ROLES, C.TRAIN_FOLDS))


def fold_encoding(spark, folder):
    """Every case's features as the model sees them that has not seen the case's fold."""
    df = folded(spark, folder)
    fit = models.TreeFit(df, "bagged")
    inside = None
    for _, valid in fit.prepare_folds(df, C.TRAIN_FOLDS):
        inside = valid if inside is None else inside.unionByName(valid)
    names = F.array(*[F.lit(c) for c in fit.features])
    cells = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("x"))
    return inside.select(C.KEY, "fold", F.inline(cells))


def target_codes(spark, folder):
    """The dictionary of three nominal columns of order lines, and the codes without each of three folds."""
    lines = tables.table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linestatus",
        (F.col("l_linenumber") % 3 + 1).alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    counts = dictionary.fold_counts(lines, ["l_partkey", "l_suppkey", "l_linestatus"], "label", 3)
    without = [F.get("codes", F.lit(k - 1)).alias(f"without_{k}") for k in (1, 2, 3)]
    return dictionary.dictionary(counts, C.MAX_CODES, 3).select("feature", "value", "rows", "code", *without)


def wide_cases(spark, folder):
    """Cases with one more nominal column of many values, the part of the order's first line."""
    lines = tables.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias(C.KEY))
    first = lines.agg(F.min(F.struct("l_linenumber", "l_partkey"))["l_partkey"].cast("string").alias("peca"))
    return screened(spark, folder).join(first, C.KEY, "left")


def wide_nominal_scores(spark, folder):
    """Boosted trees on cases with a wide nominal column, which a dictionary encodes."""
    df = staged(wide_cases(spark, folder), "wide")
    return models.score(models.TreeFit(df, "boosted")(df, BOOSTED), df, C.KEY, "cargo")


def wide_codes(spark, folder):
    """The selectors' codes of the wide nominal column: by the dictionary of the other folds."""
    df = staged(wide_cases(spark, folder).select(C.KEY, "label", "peca"), "wide")
    fold = folds.stratified_folds(df, C.KEY, "label", C.SELECTOR_FOLDS)
    encoded, _, _ = binning.encoded_features(fold, ROLES, folds=C.SELECTOR_FOLDS, max_nominal=100)
    return encoded.select(C.KEY, "fold", "peca")


def oof_predictions(spark, folder):
    df = folded(spark, folder)
    return models.out_of_fold(df, models.TreeFit(df, "bagged"), BAGGED, threads=8)


def search_results(spark, folder):
    df = folded(spark, folder)
    fit = fitter("bagged", df, ROLES, TrainSettings())
    return search.search(df, fit, "bagged", trials=2, threads=8)


def oof_coverage(spark, folder):
    """Out-of-fold rows: every case once, in its own fold, with a class and that class's probability."""
    said = F.col("prediction").isin(0, 1) & F.col("probability").between(0.5, 1.0)
    return oof_predictions(spark, folder).select(C.KEY, "fold", "label", said.alias("scored"))


def _boosted(spark, folder):
    df = screened(spark, folder)

    def make():
        fit = models.TreeFit(df, "boosted")
        return fit, fit(df, BOOSTED)

    return (df, *_once(spark, folder, "boosted", make))


def tree_attribution(spark, folder):
    df, fit, model = _boosted(spark, folder)
    return attributions(df, model, fit.features, C.KEY)


def attribution_gaps(spark, folder):
    """Whether the parts of every case and the base add up to the model's margin."""
    df, fit, model = _boosted(spark, folder)
    leaves, _ = attribution.tree_leaves(spark, model.stages[-1])
    parts = attribution.attribute(df, model, leaves, fit.features, C.KEY).groupBy(C.KEY).agg(F.sum("contribution").alias("s"))
    margin = 2.0 * F.get(vector_to_array("rawPrediction"), 1)
    gap = F.abs(F.col("s") + F.lit(attribution.base_value(leaves)) - F.col("m"))
    scored = model.transform(df).select(C.KEY, margin.alias("m"))
    return parts.join(scored, C.KEY).select(C.KEY, (gap < 1e-6).alias("additive"))


def _trained(spark, folder):
    """A model directory whose model, trained on four fifths of the cases, holds a stage."""

    def make():
        root = scratch_path(spark, "root")
        past = screened(spark, folder).drop("label").where(F.col(C.KEY) % 5 != 0)
        run = train(past, root, "bagged", settings=TrainSettings(trials=1, threads=8))
        ledger.promote(spark, root, run["run_id"], "outcome", "Production")
        return root

    return _once(spark, folder, "trained", make)


def _future(spark, folder):
    return cases(spark, folder).where(F.col(C.KEY) % 5 == 0)


def scoring_job(spark, folder):
    root = _trained(spark, folder)
    scored, _ = score_future(spark, _future(spark, folder), root, "outcome", "Production", scratch_path(spark, "out"))
    return scored


def scored_files(spark, folder):
    """Scoring of a file; what it returns is read back from the files that the job wrote."""
    root, path, out = _trained(spark, folder), scratch_path(spark, "future"), scratch_path(spark, "out")
    tables.write_csv(_future(spark, folder).drop(C.TARGET), path)
    score_file(spark, path, root, "outcome", "Production", out)
    shape = f"{C.KEY} bigint, cargo string, predict int, probability double"
    back = spark.read.schema(shape).option("header", True).csv(f"{out}/predictions")
    evidence = spark.read.option("header", True).csv(f"{out}/evidences")
    said = F.col("predict").isin(0, 1) & F.col("probability").between(0.5, 1.0)
    rows = evidence.agg(F.count("*").cast("int").alias("evidence_rows"), F.lit(1).alias("__one"))
    joined = back.withColumn("__one", F.lit(1)).join(F.broadcast(rows), "__one")
    return joined.select(C.KEY, "cargo", said.alias("scored"), "evidence_rows")


def prepare_job(spark, folder):
    """The feature job with its four selectors: what each column's votes come to."""
    settings = SelectorSettings(keep=KEEP, shadow_rounds=20, shadow_trees=30)
    return prepare(cases(spark, folder), settings=settings)[1]


# Evidence


def attribution_totals(spark, folder):
    return rounded(flag_totals(spark, folder), "sum_abs")


def global_importance(spark, folder):
    return rounded(evidence.global_importance(flag_totals(spark, folder)), "importance")


def favourable_value(spark, folder):
    return evidence.favourable_values(flag_totals(spark, folder))


def impact_label(spark, folder):
    df = labelled(spark, folder)
    found = evidence.favourable_values(flag_totals(spark, folder))
    return evidence.impact_labels(df, found, ROLES.evidence(df))


def impact_by_code(spark, folder):
    df = labelled(spark, folder)
    flags = ROLES.evidence(df)
    codes = encode.code_table(df, flags, missing=None)
    marked = screen.columns_with_value(df, flags).withColumnRenamed("present", "has_invalid")
    return codes.join(F.broadcast(marked), "feature").select(
        "feature", "value", "code", "has_invalid", evidence.impact_by_code(F.col("code"), F.col("has_invalid")).alias("impact")
    )


def _evidence(spark, folder):
    flags = ROLES.evidence(labelled(spark, folder))
    return evidence.evidence_table(flag_totals(spark, folder), flags)


def evidence_table(spark, folder):
    return rounded(_evidence(spark, folder), "value_importance")


def evidence_text_round_trip(spark, folder):
    texts = evidence.evidence_texts(_evidence(spark, folder))
    return rounded(evidence.evidence_from_texts(texts), "value_importance")


def evidence_per_row(spark, folder):
    scored = labelled(spark, folder).select(C.KEY)
    return evidence.with_evidence(scored, _evidence(spark, folder)).select(
        C.KEY, F.get_json_object("provas", "$.0").alias("first_feature"), F.get_json_object("impacto", "$.0").alias("first_impact")
    )


def dummy_draws(spark, folder):
    draw = uniform(F.concat(F.col(C.KEY).cast("string"), F.lit(f":dummy:{C.SEED}")))
    said = resample.dummy_predictions(labelled(spark, folder), C.KEY, "label")
    return said.select(C.KEY, F.round(draw, 9).alias("draw"), "prediction")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_raw, scan_prepared, conform_schema, scores_round_trip, model_lookup, run_names, preview, table_shape,
        screened_table, column_roles, cast_types, packed_features, unpacked_result, valid_values, value_present,
        invalid_marker_columns, fill_missing, class_balance, counts_by_outcome, distinct_values, column_modes,
        column_centres, crosstab_outcome, profile_numeric, profile_categorical, frequent_values, histogram,
        duplicate_rows, low_variance_screen, low_variance_all_columns, screen_rules, high_cardinality, high_card_columns,
        explore_job, future_from_csv, feature_difference,
        label_encode, category_codes, frequency_encode, mean_impute, feature_codes, class_weights, stratified_folds,
        oversample, oversample_labels, dummy_baseline, dummy_draws, confusion_metrics, macro_f1, classification_report,
        mutual_information, top_k_features, bottom_features, selector_vote, forward_step, forward_selection, forest_forward_step,
        genetic_selection, boruta_ranking, trial_tables, best_trial, naive_scores, additive_round1, additive_scores,
        fold_encoding, target_codes, wide_codes, wide_nominal_scores, oof_predictions, oof_coverage, search_results, tree_attribution, attribution_gaps, scoring_job,
        scored_files, prepare_job, attribution_totals, global_importance,
        favourable_value, impact_label, impact_by_code, evidence_table, evidence_text_round_trip, evidence_per_row,
    )
}
QUERIES |= {
    "contingency": counts_by_outcome,
    "subset_scores": subset_score_table,
    "gbt_scores": _tree_scores("boosted", BOOSTED),
    "forest_scores": _tree_scores("bagged", BAGGED),
}
del QUERIES["counts_by_outcome"]
