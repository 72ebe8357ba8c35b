"""Small integer codes for every feature: nominal values by place, numerics by quantile bin.

Code 0 stands for missing or unseen. A numeric feature keeps at most ``max_bins`` codes. A nominal one
keeps all its values, at most ``MAX_NOMINAL``; columns of more values are numbers before they are binned, codes of a
dictionary or, where there are too many values for their rows, frequencies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.operators.dictionary import attach, dictionary, fold_counts
from docket.operators.encode import FrequencyEncoder, fill_numeric_means, label_of
from docket.operators.folds import stratified_folds
from docket.operators.lookup import BROADCAST_ROWS
from docket.operators.order_stats import exact_quantiles
from docket.operators.screen import column_kinds
from docket.schema import Roles
from docket.session import staged


@dataclass(frozen=True)
class Bins:
    """Values of nominal features and inner cuts of numeric ones."""

    nominal: dict[str, list[str]] = field(default_factory=dict)
    numeric: dict[str, list[float]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.nominal, *self.numeric]

    @property
    def columns(self) -> list[str]:
        """Names of the code columns."""
        return [f"b{i}" for i in range(len(self.names))]

    def size(self, name: str) -> int:
        """Number of codes of a feature, the missing code included."""
        return 1 + (len(self.nominal[name]) if name in self.nominal else len(self.numeric[name]) + 1)

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Columns ``(*keep, b0, b1, ...)`` of integer codes in the order of ``names``."""
        cuts = {n: [float("-inf"), *c, float("inf")] for n, c in self.numeric.items()}
        if cuts:
            df = df.withColumns({f"__x_{n}": F.col(n).cast("double") for n in cuts})
            df = Bucketizer(
                splitsArray=[c if len(c) > 2 else [c[0], 0.0, c[1]] for c in cuts.values()],
                inputCols=[f"__x_{n}" for n in cuts],
                outputCols=[f"__bin_{n}" for n in cuts],
                handleInvalid="keep",
            ).transform(df)
        codes = []
        for name, column in zip(self.names, self.columns):
            if name in self.nominal:
                # A literal map is looked up by hash; a list would be read from its start.
                values = {v: i for i, v in enumerate(self.nominal[name], 1)}
                code = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(name).cast("string")] if values else F.lit(0)
            else:
                known = F.col(name).isNotNull() & ~F.isnan(F.col(f"__x_{name}"))
                code = F.when(known, F.col(f"__bin_{name}") + 1 if len(cuts[name]) > 2 else F.lit(1))
            codes.append(F.coalesce(code, F.lit(0)).cast("int").alias(column))
        return df.select(*keep, *codes)


def fit_bins(
    df: DataFrame,
    nominal: Sequence[str],
    numeric: Sequence[str],
    max_bins: int = 16,
) -> Bins:
    """Learn the values and the quantile cuts; callers give nominal columns of at most ``MAX_NOMINAL`` values."""
    values: dict[str, list[str]] = {}
    if nominal:
        row = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(c) for c in nominal]).first()
        values = {c: list(row[c]) for c in nominal}
    cuts: dict[str, list[float]] = {c: [] for c in numeric}
    if numeric:
        probs = [i / max_bins for i in range(1, max_bins)]
        for r in exact_quantiles(df, numeric, probs, interpolate=False).collect():
            cuts[r["feature"]].append(r["value"])
    return Bins(values, {c: sorted(set(v)) for c, v in cuts.items()})


def encoded_features(
    df: DataFrame, roles: Roles = Roles(), broadcast_rows: int = BROADCAST_ROWS, max_nominal: int = C.MAX_NOMINAL, folds: int = 0
) -> tuple[DataFrame, list[str], list[str]]:
    """The table ready for binning, with its nominal and numeric feature names.

    Columns of many values become codes of a dictionary, learned from ``label`` in the other folds than the row's own, or their
    frequencies if they have too many values for their rows; numeric nulls become means.
    """
    numeric = roles.numeric(df)
    high, wide, nominal = column_kinds(df, roles.categorical(df), max_nominal=max_nominal)
    columns, swap = df.columns, {}
    if high:
        swap |= {c: f"__freq_{c}" for c in high}
        spare = [swap[c] for c in high]
        encoder = FrequencyEncoder(inputCols=high, outputCols=spare, spreadCol=roles.key, broadcastRows=broadcast_rows)
        df = encoder.fit(df).transform(df)
    if wide:
        table = staged(dictionary(fold_counts(df, wide, "label", folds), C.MAX_CODES, folds), "dictionary", partition_by="feature")
        for c in wide:
            swap[c] = f"__target_{c}"
            df = attach(df, table, c, "__codes", "codes" if folds else "code", roles.key, broadcast_rows)
            own = F.get("__codes", F.col("fold") - 1) if folds else F.col("__codes")
            df = df.withColumn(swap[c], F.coalesce(own, F.lit(0)).cast("double")).drop("__codes")
    if swap:
        df = df.select(*[F.col(swap.get(c, c)).alias(c) for c in columns])
    if numeric:
        df = fill_numeric_means(df, numeric)
    return df, nominal, [*high, *wide, *numeric]


def selection_frame(
    df: DataFrame, roles: Roles = Roles(), max_bins: int = 16, folds: int = C.SELECTOR_FOLDS, max_nominal: int = C.MAX_NOMINAL
) -> tuple[DataFrame, Bins]:
    """Columns ``(key, label, fold, b0, b1, ...)``: the one input of all selectors."""
    labelled = label_of(df, roles.target).filter("label is not null")
    folded = stratified_folds(labelled, roles.key, "label", folds)
    encoded, nominal, numeric = encoded_features(folded, roles, max_nominal=max_nominal, folds=folds)
    ready = staged(encoded.select(roles.key, "label", "fold", *nominal, *numeric), "encoded")
    bins = fit_bins(ready, nominal, numeric, max_bins)
    return staged(bins.apply(ready, [roles.key, "label", "fold"]), "codes"), bins
