"""Four feature selectors and their vote."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from statistics import median

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docket import constants as C
from docket.operators.binning import Bins
from docket.operators.cell_forest import CellForest, code_counts, drawn_cells
from docket.operators.contingency import class_counts
from docket.operators.metrics import macro_f1
from docket.operators.resample import add_class_weight, class_weights
from docket.operators.subset_scores import compact, fold_log_odds, odds_arrays, subset_scores
from docket.session import partitions_of, ship, staged

Scorer = Callable[[Sequence[Sequence[int]]], list[float]]


def mutual_information(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Rows ``(feature, mi)``: plug-in mutual information with a 0/1 label, in nats.

    Written as sums of n ln n, which combine on the map side at any cardinality.
    """
    x_log_x = lambda n: F.when(n > 0, n * F.log(n.cast("double"))).otherwise(0.0)
    n0, n1 = F.col("n0"), F.col("n1")
    sums = class_counts(df, columns, label).groupBy("feature").agg(
        F.sum(x_log_x(n0) + x_log_x(n1)).alias("joint"),
        F.sum(x_log_x(n0 + n1)).alias("by_value"),
        F.sum("n0").alias("n0"),
        F.sum("n1").alias("n1"),
    )
    rows = n0 + n1
    mi = (F.col("joint") - F.col("by_value") - x_log_x(n0) - x_log_x(n1) + x_log_x(rows)) / rows
    return sums.select("feature", mi.alias("mi"))


def ranked(scores: DataFrame, score: str, feature: str = "feature") -> DataFrame:
    """Add ``place``, 1 for the highest score; names break ties. One row per feature."""
    order = Window.orderBy(F.desc(score), F.asc(feature))
    return scores.withColumn("place", F.row_number().over(order))


def top_features(scores: DataFrame, score: str, k: int = C.KEEP_FEATURES) -> DataFrame:
    """The k best features."""
    return ranked(scores, score).filter(F.col("place") <= k)


def bottom_features(scores: DataFrame, score: str, k: int = C.KEEP_FEATURES) -> DataFrame:
    """All but the k best features; none if there are no more than k."""
    return ranked(scores, score).filter(F.col("place") > k)


class CellScorer:
    """Macro-F1 of feature subsets from cells; one job per call, any number of subsets."""

    def __init__(self, codes: DataFrame, bins: Bins, folds: int = C.SELECTOR_FOLDS):
        self.cells = staged(compact(codes, bins), "cells")
        self.bins = bins
        self.odds = odds_arrays(fold_log_odds(self.cells, bins, folds), bins, folds)

    def __call__(self, masks: Sequence[Sequence[int]]) -> list[float]:
        rows = subset_scores(self.cells, self.bins, self.odds, masks).collect()
        found = {r["mask"]: r["macro_f1"] for r in rows}
        return [found.get(m, 0.0) for m in range(len(masks))]


class ForestScorer:
    """Macro-F1 of feature subsets by a small balanced forest per subset and fold, grown from the subset's cells."""

    def __init__(self, codes: DataFrame, bins: Bins, folds: int = C.SELECTOR_FOLDS, trees: int = 20, threads: int = 8):
        # Before the threads start, since each of them would send it.
        ship(codes.sparkSession)
        self.codes = staged(codes.select("fold", "label", *bins.columns), "scored")
        self.bins, self.folds, self.trees, self.threads = bins, folds, trees, threads
        self.counts = code_counts(self.codes, bins.columns, folds) if bins.columns else {}
        found = {r["label"]: r["weight"] for r in class_weights(self.codes.filter("label is not null"), "label").collect()}
        self.weights = [found.get(label, 1.0) for label in (0, 1)]

    def __call__(self, masks: Sequence[Sequence[int]]) -> list[float]:
        # Subsets are independent jobs over the one table of codes.
        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            return list(pool.map(inheritable_thread_target(self.codes.sparkSession)(self._score), masks))

    def _score(self, mask: Sequence[int]) -> float:
        if not mask:
            return 0.0
        columns = [self.bins.columns[i] for i in mask]
        cells = staged(drawn_cells(self.codes, columns, self.trees), "drawn")
        forest = CellForest([self.counts[c] for c in columns], self.weights, self.folds, self.trees)
        counts = forest.grow(cells, columns).confusions(cells, columns)
        return macro_f1(counts, average="fold").first()["macro_f1"]


def forward_selection(
    spark: SparkSession, names: Sequence[str], scorer: Scorer, k: int = C.KEEP_FEATURES
) -> DataFrame:
    """Greedy additions, rows ``(step, feature, macro_f1)``; all candidates of a step in one call."""
    chosen: list[int] = []
    steps: list[tuple[int, str, float]] = []
    while len(chosen) < min(k, len(names)):
        candidates = [i for i in range(len(names)) if i not in chosen]
        scores = scorer([[*chosen, i] for i in candidates])
        best = max(range(len(candidates)), key=lambda j: (round(scores[j], 9), -j))
        chosen.append(candidates[best])
        steps.append((len(chosen), names[candidates[best]], scores[best]))
    return spark.createDataFrame(steps, "step int, feature string, macro_f1 double")


def genetic_selection(
    spark: SparkSession,
    names: Sequence[str],
    scorer: Scorer,
    k: int = C.KEEP_FEATURES,
    population: int = C.POPULATION,
    generations: int = C.GENERATIONS,
    patience: int = C.GENERATIONS_WITHOUT_GAIN,
    crossover: float = 0.5,
    mutation: float = 0.2,
    swap: float = 0.1,
    flip: float = 0.05,
    tournament: int = 3,
    seed: int = C.SEED,
) -> DataFrame:
    """Best subset per generation, rows ``(generation, macro_f1, features array)``.

    The population is a handful of masks; scoring a generation is one Spark job.
    """
    draw = random.Random(seed)
    p = len(names)

    def trimmed(mask: set[int]) -> tuple[int, ...]:
        mask = mask or {draw.randrange(p)}
        return tuple(sorted(draw.sample(sorted(mask), min(k, len(mask)))))

    known: dict[tuple[int, ...], float] = {}

    def fitness(masks):
        new = [m for m in dict.fromkeys(masks) if m not in known]
        if new:
            known.update(zip(new, scorer(new)))
        return [known[m] for m in masks]

    herd = [trimmed({i for i in range(p) if draw.random() < 0.5}) for _ in range(population)]
    best, history, idle = None, [], 0
    for generation in range(generations + 1):
        scores = fitness(herd)
        top = max(range(len(herd)), key=lambda i: (scores[i], -len(herd[i])))
        if best is None or scores[top] > known[best]:
            best, idle = herd[top], 0
        else:
            idle += 1
        history.append((generation, known[best], [names[i] for i in best]))
        if idle >= patience:
            break
        parents = [
            herd[max((draw.randrange(len(herd)) for _ in range(tournament)), key=lambda i: scores[i])]
            for _ in range(population)
        ]
        herd = []
        for a, b in zip(parents[::2], parents[1::2] or parents[:1]):
            a, b = set(a), set(b)
            if draw.random() < crossover:
                swapped = {i for i in a ^ b if draw.random() < swap}
                a, b = a ^ swapped, b ^ swapped
            for child in (a, b):
                if draw.random() < mutation:
                    child = child ^ {i for i in range(p) if draw.random() < flip}
                herd.append(trimmed(child))
        herd = [best, *herd[: population - 1]]
    return spark.createDataFrame(history, "generation int, macro_f1 double, features array<string>")


def _binomial_tail(hits: int, rounds: int) -> float:
    """P(at least ``hits`` of ``rounds`` fair coins)."""
    log_choose = lambda h: math.lgamma(rounds + 1) - math.lgamma(h + 1) - math.lgamma(rounds - h + 1)
    return min(1.0, sum(math.exp(log_choose(h) - rounds * math.log(2)) for h in range(hits, rounds + 1)))


def below_false_discovery(chances: Sequence[float], alpha: float) -> list[bool]:
    """Which chances pass at a false discovery rate (Benjamini and Hochberg): all up to the largest that lies under its line."""
    order = sorted(range(len(chances)), key=lambda i: chances[i])
    passed = max((k for k, i in enumerate(order, 1) if chances[i] <= alpha * k / len(chances)), default=0)
    return [i in set(order[:passed]) for i in range(len(chances))]


def shadow_verdicts(hits: Sequence[int], rounds: int, alpha: float) -> list[str]:
    """What the hits of the features still in the test say after a number of rounds.

    A verdict takes two steps (Kursa and Rudnicki 2010, with the correction in two steps of its later versions): the
    chance of so many, or so few, hits passes at a false discovery rate among the features, and it lies below
    ``alpha`` over the number of rounds, as every round tests anew.
    """
    many = [_binomial_tail(h, rounds) for h in hits]
    few = [_binomial_tail(rounds - h, rounds) for h in hits]
    out = ["tentative"] * len(hits)
    for chances, verdict in ((many, "confirmed"), (few, "rejected")):
        for i, passed in enumerate(below_false_discovery(chances, alpha)):
            if passed and chances[i] <= alpha / rounds:
                out[i] = verdict
    return out


def _median_ranks(history: Sequence[dict[str, float]], columns: Sequence[str]) -> dict[str, float]:
    """The median place of each column by importance, over the rounds that it was in."""
    places: dict[str, list[int]] = {c: [] for c in columns}
    for weights in history:
        for place, c in enumerate(sorted(weights, key=lambda c: (-weights[c], c)), 1):
            places[c].append(place)
    return {c: float(median(p)) if p else math.inf for c, p in places.items()}


def shadow_blocks(codes: DataFrame, key: str, columns: Sequence[str], blocks: int) -> DataFrame:
    """Rows grouped into hash blocks of even size, one array of rows per block."""
    row = F.struct(F.xxhash64(key).alias("h"), "label", "weight", *columns)
    return codes.groupBy(F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )


def with_shadows(blocked: DataFrame, columns: Sequence[str], round_no: int) -> DataFrame:
    """Flat rows with a copy ``s_<column>`` of each column, permuted within its block."""

    def permuted(column: str) -> Column:
        drawn = F.transform(
            "rows",
            lambda r: F.struct(
                F.xxhash64(r["h"], F.lit(column), F.lit(round_no)).alias("o"), r[column].alias(f"s_{column}")
            ),
        )
        return F.transform(F.sort_array(drawn), lambda r: r[f"s_{column}"])

    shadows = blocked.select("rows", *[permuted(c).alias(f"s_{c}") for c in columns])
    zipped = F.arrays_zip("rows", *[f"s_{c}" for c in columns])
    return shadows.select(F.explode(zipped).alias("z")).select(
        "z.rows.h", "z.rows.label", "z.rows.weight", *[f"z.rows.{c}" for c in columns], *[f"z.s_{c}" for c in columns]
    )


def shadow_selection(
    codes: DataFrame,
    bins: Bins,
    key: str = C.KEY,
    rounds: int = 20,
    trees: int = 30,
    block_rows: int = 2000,
    alpha: float = 0.05,
) -> DataFrame:
    """Rows ``(feature, hits, rounds, importance, verdict, place)``.

    Every round a balanced forest sees the features and their permuted copies. A
    feature scores a hit when it matters more than the best copy. Confirmed and
    rejected follow from :func:`shadow_verdicts`; a verdict stays, and rejected features leave the later rounds.
    Features of one verdict are placed by the median of their places over the rounds. Permuting inside hash blocks
    costs one shuffle for all rounds, and the blocks stay even under any skew
    because keys are unique. Whole blocks are dealt to the learner's partitions, once for all rounds.
    """
    spark = codes.sparkSession
    weighted = add_class_weight(codes, "label")
    rows = weighted.count()
    blocks = max(1, math.ceil(rows / block_rows))
    # Which blocks make a partition follows from the rows alone, so the draws do too.
    blocked = staged(shadow_blocks(weighted, key, bins.columns, blocks), "blocks").repartition(partitions_of(rows), "block").persist()
    name_of = dict(zip(bins.columns, bins.names))
    active = list(bins.columns)
    hits, seen, importance = ({c: 0 for c in active} for _ in range(3))
    verdict = {c: "tentative" for c in active}
    history: list[dict[str, float]] = []
    for round_no in range(1, rounds + 1):
        inputs = [*active, *[f"s_{c}" for c in active]]
        flat = with_shadows(blocked, active, round_no)
        # A fit reads its input several times; the permutations are drawn once and kept while it lasts.
        vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(flat)
        vectors = vectors.select("h", "label", "weight", "features").sortWithinPartitions("h").persist()
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=C.SELECTOR_DEPTH, weightCol="weight", seed=C.SEED + round_no
        ).fit(vectors)
        vectors.unpersist()
        weights = dict(zip(inputs, forest.featureImportances.toArray()))
        best_shadow = max(weights[f"s_{c}"] for c in active)
        for c in active:
            hits[c] += int(weights[c] > best_shadow)
            seen[c] += 1
            importance[c] += float(weights[c])
        history.append({c: weights[c] for c in active})
        open_ = [c for c in active if verdict[c] == "tentative"]
        verdict |= dict(zip(open_, shadow_verdicts([hits[c] for c in open_], round_no, alpha)))
        active = [c for c in active if verdict[c] != "rejected"]
        if not any(verdict[c] == "tentative" for c in active):
            break
    blocked.unpersist()
    middle = _median_ranks(history, list(name_of))
    standing = {"confirmed": 0, "tentative": 1, "rejected": 2}
    order = sorted(name_of, key=lambda c: (standing[verdict[c]], middle[c], -importance[c] / max(seen[c], 1), name_of[c]))
    return spark.createDataFrame(
        [
            (name_of[c], hits[c], seen[c], importance[c] / max(seen[c], 1), verdict[c], place)
            for place, c in enumerate(order, 1)
        ],
        "feature string, hits int, rounds int, importance double, verdict string, place int",
    )


def vote(dropped: DataFrame, votes: int = C.VOTES_TO_DROP) -> DataFrame:
    """Rows ``(feature, votes, protected, removed)`` from stacked ``(selector, feature)`` rows.

    A feature goes when more than ``votes`` selectors drop it. Evidence and job
    columns are kept whatever the votes, except the tenure columns.
    """
    name = F.col("feature")
    shielded = (name.contains(C.EVIDENCE_PATTERN) | name.contains(C.JOB_TITLE)) & ~name.contains(C.TENURE_PATTERN)
    counted = dropped.groupBy("feature").agg(F.count("*").alias("votes"))
    return counted.select(
        "feature", "votes", shielded.alias("protected"), ((F.col("votes") > votes) & ~shielded).alias("removed")
    )
