"""Encoders: label codes, frequencies, fills; fitted ones are Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
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
from pyspark.sql import DataFrame, functions as F

from docket import constants as C
from docket.operators.contingency import contingency, long_values
from docket.operators.lookup import BROADCAST_ROWS, lookup_number
from docket.operators.order_stats import global_index
from docket.session import staged


def code_table(df: DataFrame, columns: Sequence[str], missing: str | None = C.MISSING) -> DataFrame:
    """Rows ``(feature, value, code)``: place of each value in its column's sorted values.

    Nulls take part under the ``missing`` word, or stay out when it is None. Values
    are ordered over the whole table at once by a range-partitioned sort, so a
    column with very many values is not ranked in one task.
    """
    values = long_values(df, columns)
    if missing is None:
        values = values.filter(F.col("value").isNotNull())
    else:
        values = values.fillna({"value": missing})
    placed = global_index(values.distinct(), "feature", "value")
    starts = placed.groupBy("feature").agg(F.min("position").alias("start"))
    return placed.join(F.broadcast(starts), "feature").select(
        "feature", "value", (F.col("position") - F.col("start")).cast("int").alias("code")
    )


def label_of(df: DataFrame, target: str, name: str = "label") -> DataFrame:
    """Add the two-class target as 0/1 by the sorted order of its values; null stays null.

    A target that has not exactly two values is an error.
    """
    found = df.select(target).where(F.col(target).isNotNull()).distinct().limit(3).collect()
    if len(found) != 2:
        raise ValueError(f"{target} has {len(found) if len(found) < 3 else 'more than two'} values, two are needed")
    lowest = min(r[0] for r in found)
    return df.withColumn(name, F.when(F.col(target) == F.lit(lowest), 0).when(F.col(target).isNotNull(), 1))


def fill_numeric_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with each column's mean over the whole table."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in columns})


class _Columns(HasInputCols, HasOutputCols):
    spreadCol = Param(Params._dummy(), "spreadCol", "key that spreads rows without a partner", TypeConverters.toString)
    broadcastRows = Param(Params._dummy(), "broadcastRows", "largest table to broadcast", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(spreadCol=C.KEY, broadcastRows=BROADCAST_ROWS)


class FrequencyEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replace a value by how often it occurs in the training rows; unseen and null give 0."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, spreadCol=None, broadcastRows=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        # Written once to the shared folder: a transform reads one column's counts, none recomputes them.
        counts = contingency(dataset, self.getInputCols()).filter(F.col("value").isNotNull())
        return self._copyValues(FrequencyEncoderModel(staged(counts, "counts", partition_by="feature")))


class _CountsWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.counts.write.mode("overwrite").partitionBy("feature").parquet(f"{path}/counts")


class _CountsReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        counts = self.sparkSession.read.schema("feature string, value string, n bigint").parquet(f"{path}/counts")
        stage = self.kind(counts)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class FrequencyEncoderModel(Model, _Columns, MLReadable, MLWritable):
    """Fitted frequencies: a table ``(feature, value, n)``."""

    def __init__(self, counts: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.counts = counts

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out in zip(self.getInputCols(), self.getOutputCols()):
            numbers = self.counts.filter(F.col("feature") == column).select("value", "n")
            dataset = lookup_number(
                dataset, numbers, column, out, self.getOrDefault("spreadCol"), 0.0, self.getOrDefault("broadcastRows")
            )
        return dataset

    def write(self) -> MLWriter:
        return _CountsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CountsReader(cls)


class NumericFill(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill numeric nulls from the training rows.

    ``mean`` puts the mean. ``below_min`` puts a number below all others, which
    lets one tree split set the missing rows apart.
    """

    strategy = Param(Params._dummy(), "strategy", "mean or below_min", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, strategy="mean"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NumericFillModel:
        fill = (lambda c: F.avg(c)) if self.getOrDefault("strategy") == "mean" else (lambda c: F.min(c) - 1.0)
        names = self.getInputCols()
        row = dataset.agg(*[fill(F.col(c).cast("double")).alias(c) for c in names]).first()
        model = NumericFillModel()
        model._set(fills=[0.0 if row[c] is None else float(row[c]) for c in names])
        return self._copyValues(model)


class NumericFillModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted fills, one number per column."""

    fills = Param(Params._dummy(), "fills", "fill per column", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        columns = {
            out: F.coalesce(known(c), F.lit(fill))
            for c, out, fill in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("fills"))
        }
        return dataset.withColumns(columns)


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(feature, value, code, n)``: sorted codes with counts, null as -1."""
    codes = code_table(df, columns, missing=None)
    return (
        contingency(df, columns)
        .join(codes, ["feature", "value"], "left")
        .select("feature", "value", F.coalesce("code", F.lit(-1)).alias("code"), "n")
    )
