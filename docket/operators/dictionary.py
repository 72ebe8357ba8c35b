"""A dictionary of nominal values: every value of a column gets one of a bounded number of codes, ordered by the target.

For columns of many values. A value's code grows with its share of positive rows, drawn towards the share of
all rows where it is rare. Shares are cut into ``LEVELS`` even levels, and levels of like mass share a code, so the
codes of a column come from at most ``LEVELS`` numbers and no column's values are ever sorted or collected. The dictionary is a
table in the shared folder that is joined, not a list in a plan.

A threshold on codes parts values by their share of positives, which for a two-class target is the best way to split
a set of values (Breiman et al. 1984). A null, and a value that the dictionary does not have, has code 0.

The counts are kept by fold. A dictionary without a fold follows from the totals less that fold's counts, so
ten folds need one pass over the rows and not ten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from docket import constants as C
from docket.operators.contingency import long_values
from docket.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, look_up
from docket.session import staged

#: A value's share of positives is cut into so many even levels.
LEVELS = 1024
#: A value counts as if it had so many more rows of the average share.
SMOOTHING = 10.0


def fold_counts(df: DataFrame, columns: Sequence[str], label: str, folds: int = 0, fold: str = "fold") -> DataFrame:
    """Rows ``(feature, value, n, n1, by_fold)`` of all known values: rows, positive rows, and the same inside each fold.

    Every value is one row whatever its share of the data: counts of all folds are combined before the shuffle.
    """
    long = long_values(df, columns, [label, *([fold] if folds else [])]).where("value is not null")
    n1 = lambda where: F.count_if(where & (F.col(label) == 1))
    inside = [(F.col(fold) == k) for k in range(1, folds + 1)]
    cells = [x for w in inside for x in (F.count_if(w), n1(w))]
    names = [f"__{kind}{k}" for k in range(1, folds + 1) for kind in ("n", "p")]
    counted = long.groupBy("feature", "value").agg(
        F.count("*").alias("n"), n1(F.lit(True)).alias("n1"), *[c.alias(name) for c, name in zip(cells, names)]
    )
    pairs = [F.struct(F.col(f"__n{k}").alias("n"), F.col(f"__p{k}").alias("n1")) for k in range(1, folds + 1)]
    by_fold = F.array(*pairs) if pairs else F.lit(None).cast("array<struct<n:bigint,n1:bigint>>")
    return counted.select("feature", "value", "n", "n1", by_fold.alias("by_fold"))


def _level(n: Column, n1: Column, share: Column) -> Column:
    rate = (n1 + F.lit(SMOOTHING) * share) / (n + F.lit(SMOOTHING))
    return F.least(F.floor(rate * LEVELS), F.lit(LEVELS - 1)).cast("int")


def dictionary(counts: DataFrame, max_codes: int, folds: int = 0) -> DataFrame:
    """Rows ``(feature, value, rows, code, codes)`` from :func:`fold_counts`.

    ``code`` is that of all rows; ``codes`` has, for each fold, the code without the fold's rows, and
    null if no other fold has the value.
    """
    # View 0 is that of all rows, view k that without fold k.
    everything = F.array(F.struct(F.lit(0).alias("view"), "n", "n1"))
    without = F.transform(
        F.coalesce("by_fold", F.expr("array()")),
        lambda f, i: F.struct((i + 1).alias("view"), (F.col("n") - f["n"]).alias("n"), (F.col("n1") - f["n1"]).alias("n1")),
    ) if folds else None
    views = F.concat(everything, without) if folds else everything
    long = counts.select("feature", "value", F.col("n").alias("rows"), F.inline(views)).where("n > 0")
    shares = long.groupBy("feature", "view").agg((F.sum("n1") / F.sum("n")).alias("share"))
    # One row for each feature and view.
    levelled = long.join(F.broadcast(shares), ["feature", "view"]).withColumn("level", _level(F.col("n"), F.col("n1"), F.col("share")))
    masses = levelled.groupBy("feature", "view", "level").agg(F.sum("n").alias("mass"))
    # At most LEVELS rows in each of these windows.
    view = Window.partitionBy("feature", "view")
    before = F.sum("mass").over(view.orderBy("level")) - F.col("mass")
    cuts = masses.select("feature", "view", "level", F.floor(before * max_codes / F.sum("mass").over(view)).alias("cut"))
    ranks = cuts.select("feature", "view", "level", F.dense_rank().over(view.orderBy("cut")).alias("code"))
    at_level = F.map_from_entries(F.collect_list(F.struct("level", "code")))
    lists = ranks.groupBy("feature", "view").agg(at_level.alias("m")).select(
        "feature", "view", F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: F.element_at("m", k)).alias("codes")
    )
    # A list takes 4 bytes for each level, so a thousand features with ten folds take 45 MB.
    small = lists.count() * LEVELS * 4 <= BROADCAST_BYTES
    coded = levelled.join(F.broadcast(lists) if small else lists, ["feature", "view"]).withColumn("code", F.get("codes", "level"))
    by_view = F.map_from_entries(F.collect_list(F.struct("view", "code")))
    found = coded.groupBy("feature", "value").agg(F.first("rows").alias("rows"), by_view.alias("at"))
    at = lambda k: F.element_at("at", F.lit(k))
    by_fold = F.array(*[at(k) for k in range(1, folds + 1)]) if folds else F.lit(None).cast("array<int>")
    return found.select("feature", "value", "rows", at(0).alias("code"), by_fold.alias("codes"))


def attach(df: DataFrame, table: DataFrame, column: str, out: str, field: str, spread_by: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add what a dictionary has in ``field`` for one of its columns; null for values that it does not have."""
    own = table.where(F.col("feature") == column).select("value", F.col(field).alias("n"), "rows")
    return look_up(df.withColumn("__text", F.col(column).cast("string")), own, "__text", out, spread_by, broadcast_rows).drop("__text")


class _Shape(HasInputCols, HasOutputCols, HasLabelCol):
    spreadCol = Param(Params._dummy(), "spreadCol", "key that spreads rows without a partner", TypeConverters.toString)
    broadcastRows = Param(Params._dummy(), "broadcastRows", "largest table to broadcast", TypeConverters.toInt)
    maxCodes = Param(Params._dummy(), "maxCodes", "codes of a column", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(spreadCol=C.KEY, broadcastRows=BROADCAST_ROWS, maxCodes=C.MAX_CODES, labelCol="label")


class TargetCodes(Estimator, _Shape, DefaultParamsReadable, DefaultParamsWritable):
    """Replace a value by its code in the dictionary of the training rows; unseen and null give 0."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol=None, spreadCol=None, broadcastRows=None, maxCodes=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TargetCodesModel:
        counts = fold_counts(dataset, self.getInputCols(), self.getLabelCol())
        table = dictionary(counts, self.getOrDefault("maxCodes")).select("feature", "value", "rows", "code")
        return self._copyValues(TargetCodesModel(staged(table, "dictionary", partition_by="feature")))


class _TableWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.table.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/dictionary")


class _TableReader(MLReader):
    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        shape = "feature string, value string, rows bigint, code int"
        stage = TargetCodesModel(self.sparkSession.read.schema(shape).parquet(f"{path}/dictionary"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class TargetCodesModel(Model, _Shape, MLReadable, MLWritable):
    """A fitted dictionary: a table ``(feature, value, rows, code)``."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out in zip(self.getInputCols(), self.getOutputCols()):
            dataset = attach(
                dataset, self.table, column, out, "code", self.getOrDefault("spreadCol"), self.getOrDefault("broadcastRows")
            ).withColumn(out, F.coalesce(out, F.lit(0)).cast("double"))
        return dataset

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader()
