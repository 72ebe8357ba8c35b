"""One encoded table for all folds of a cross-validation.

What an encoder learns from the rows outside a fold is what it learns from all rows less what the fold holds. So every
value is counted once, by fold, and looked up once: a row carries its value's total count and the count
inside each fold, its codes without each fold, its number and its place among a column's values. The features that a
fold's model sees are then a projection of that row, for the rows outside the fold, which it learns from, as for those inside,
which it scores. Nothing is written for a single fold.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from docket import constants as C
from docket.operators.contingency import contingency
from docket.operators.dictionary import attach, dictionary, fold_counts
from docket.session import staged

if TYPE_CHECKING:
    from docket.operators.models import Prepared, TreeFit


class FoldTable:
    """The encoded rows of a table with ``label`` and ``fold``, as the model of any fold sees them."""

    def __init__(self, df: DataFrame, fit: TreeFit, folds: int):
        self.fit, self.folds, self.kinds, self.key = fit, folds, fit.kinds, fit.roles.key
        kinds, made = self.kinds, []
        rows = df
        if kinds.high:
            counts = fold_counts(df, kinds.high, "label", folds)
            outside = F.transform("by_fold", lambda f: F.col("n") - f["n"])
            table = staged(counts.select("feature", "value", F.col("n").alias("rows"), outside.alias("outside")), "counts", "feature")
            for c in kinds.high:
                rows = attach(rows, table, c, f"__freq_{c}", "outside", self.key)
                made.append(f"__freq_{c}")
        if kinds.wide:
            table = staged(dictionary(fold_counts(df, kinds.wide, "label", folds), C.MAX_CODES, folds), "dictionary", "feature")
            for c in kinds.wide:
                rows = attach(rows, table, c, f"__target_{c}", "codes", self.key)
                made.append(f"__target_{c}")
        # Nominal columns have at most ``max_nominal`` values: who has which is a list of bounded size.
        self.values: dict[str, list[str]] = {c: [] for c in kinds.nominal}
        self.present: dict[str, dict[str, list[int]]] = {c: {} for c in kinds.nominal}
        if kinds.nominal:
            found = contingency(df, kinds.nominal, ["fold"]).where("value is not null").groupBy("feature", "value").agg(F.collect_set("fold").alias("folds"))
            for r in found.collect():
                self.present[r["feature"]][r["value"]] = r["folds"]
            self.values = {c: sorted(v, key=str.encode) for c, v in self.present.items()}
        # The least number of each fold and column, and the rows of each fold.
        lows = [F.min(F.col(c).cast("double")).alias(c) for c in kinds.numeric]
        self.lows = {r["fold"]: r for r in df.groupBy("fold").agg(F.count("*").alias("__rows"), *lows).collect()}
        place = lambda c: F.array_position(F.lit(self.values[c]), F.col(c).cast("string")) - 1 if self.values[c] else F.lit(-1)
        nominal = [F.coalesce(place(c), F.lit(-1)).cast("int").alias(f"__place_{c}") for c in kinds.nominal]
        numeric = [F.col(c).cast("double").alias(f"__raw_{c}") for c in kinds.numeric]
        self.rows = staged(rows.select(self.key, "label", "fold", *made, *nominal, *numeric), "folds")

    def _encoded(self, fold: int) -> dict[str, Column]:
        """The encoded columns as the model without ``fold`` has them."""
        kinds, out = self.kinds, {}
        for c in kinds.high:
            out[f"__freq_{c}"] = F.coalesce(F.get(f"__freq_{c}", F.lit(fold - 1)), F.lit(0)).cast("double")
        for c in kinds.wide:
            out[f"__target_{c}"] = F.coalesce(F.get(f"__target_{c}", F.lit(fold - 1)), F.lit(0)).cast("double")
        for c in kinds.nominal:
            known = self.known(c, fold)
            at = {v: float(i) for i, v in enumerate(known)}
            # Missing and unseen values share the code after the last.
            codes = F.lit([at.get(v, float(len(known))) for v in self.values[c]] + [float(len(known))])
            place = F.col(f"__place_{c}")
            code = F.get(codes, F.when(place < 0, len(self.values[c])).otherwise(place))
            meta = {"ml_attr": {"type": "nominal", "name": f"__code_{c}", "vals": [*known, "__unknown"]}}
            out[f"__code_{c}"] = code.alias(f"__code_{c}", metadata=meta)
        for c in kinds.numeric:
            others = [r[c] for k, r in self.lows.items() if k != fold and r[c] is not None]
            raw = F.col(f"__raw_{c}")
            out[f"__num_{c}"] = F.coalesce(F.when(~F.isnan(raw), raw), F.lit(min(others) - 1.0 if others else 0.0))
        return out

    def known(self, column: str, fold: int) -> list[str]:
        """The values of a nominal column that a row outside the fold has."""
        return [v for v in self.values[column] if set(self.present[column][v]) - {fold}]

    def vectors(self, rows: DataFrame, fold: int, *keep: Column | str) -> DataFrame:
        """Rows with the ``features`` that the model without ``fold`` sees."""
        columns = self._encoded(fold)
        encoded = rows.select(*keep, *[c.alias(n) if not n.startswith("__code_") else c for n, c in columns.items()])
        assembled = VectorAssembler(inputCols=self.kinds.vector, outputCol="features").transform(encoded)
        return assembled.drop(*columns)

    def parts(self) -> list[tuple[Prepared, DataFrame]]:
        """For every fold, the balanced training rows outside and the rows inside."""
        from docket.operators.models import Prepared

        out = []
        for fold in range(1, self.folds + 1):
            train = self.fit.balanced(self.rows.where(F.col("fold") != fold))
            weight = F.col("weight").cast("double").alias("weight")
            rows = self.vectors(train, fold, F.col(self.key).alias("key"), "label", weight)
            # How many partitions the learner's rows are dealt to follows from their number.
            n = sum(r["__rows"] for k, r in self.lows.items() if k != fold) if self.fit.balance != "rows" else rows.count()
            widest = max([len(self.known(c, fold)) for c in self.kinds.nominal], default=0)
            inside = self.vectors(self.rows.where(F.col("fold") == fold), fold, self.key, "fold", "label")
            out.append((Prepared(None, rows, n, widest), inside))
        return out
