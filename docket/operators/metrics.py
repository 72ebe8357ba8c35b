"""Scores of a binary classifier, all from one count of (label, prediction)."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple = ()) -> DataFrame:
    """Rows ``(*by, label, prediction, n)``."""
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _scores(counts: DataFrame, by: tuple = ()) -> DataFrame:
    n, y, p = F.col("n"), F.col("label"), F.col("prediction")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, n)), F.lit(0))
    sums = counts.groupBy(*by).agg(
        *[total((y == c) & (p == c)).alias(f"hit{c}") for c in (0, 1)],
        *[total(p == c).alias(f"said{c}") for c in (0, 1)],
        *[total(y == c).alias(f"support{c}") for c in (0, 1)],
    )
    for c in (0, 1):
        hit, said, support = (F.col(f"{part}{c}") for part in ("hit", "said", "support"))
        sums = (
            sums.withColumn(f"recall_class{c}", _ratio(hit, support))
            .withColumn(f"precision_class{c}", _ratio(hit, said))
            .withColumn(f"f1_class{c}", _ratio(2.0 * hit, said + support))
        )
    rows = F.col("support0") + F.col("support1")
    return sums.withColumn("accuracy", _ratio(F.col("hit0") + F.col("hit1"), rows)).withColumn(
        "macro_f1", (F.col("f1_class0") + F.col("f1_class1")) / 2
    )


def metrics(counts: DataFrame, by: tuple = ()) -> DataFrame:
    """Recall, precision and F1 per class, accuracy and macro-F1 of a confusion table.

    A class that is never predicted, or never occurs, scores zero.
    """
    from docket.constants import METRICS

    return _scores(counts, by).select(*by, *METRICS, "macro_f1")


def macro_f1(counts: DataFrame, by: tuple = (), average: str = "pooled", fold: str = "fold") -> DataFrame:
    """Macro-F1 of the pooled rows, or the mean of the folds' macro-F1."""
    if average == "pooled":
        return metrics(counts, by).select(*by, "macro_f1")
    per_fold = metrics(counts, (*by, fold))
    return per_fold.groupBy(*by).agg(F.avg("macro_f1").alias("macro_f1"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Rows per class, accuracy, macro and weighted average, with support."""
    s = _scores(counts)
    support = F.col("support0") + F.col("support1")

    def line(name, precision, recall, f1, n):
        return F.struct(
            F.lit(name).alias("line"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            n.cast("bigint").alias("support"),
        )

    def blend(measure, w0, w1, whole):
        return (F.col(f"{measure}_class0") * w0 + F.col(f"{measure}_class1") * w1) / whole

    classes = [
        line(str(c), F.col(f"precision_class{c}"), F.col(f"recall_class{c}"), F.col(f"f1_class{c}"), F.col(f"support{c}"))
        for c in (0, 1)
    ]
    accuracy = F.col("accuracy")
    names = ("precision", "recall", "f1")
    macro = [blend(m, F.lit(1.0), F.lit(1.0), F.lit(2.0)) for m in names]
    weighted = [blend(m, F.col("support0"), F.col("support1"), support) for m in names]
    return s.select(
        F.inline(
            F.array(
                *classes,
                line("accuracy", accuracy, accuracy, accuracy, support),
                line("macro avg", *macro, support),
                line("weighted avg", *weighted, support),
            )
        )
    )


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Unweighted mean of the two classes' F1, for Spark ML tuning tools."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        counts = confusion(dataset, self.getLabelCol(), self.getPredictionCol())
        return float(metrics(counts).first()["macro_f1"])

    def isLargerBetter(self) -> bool:
        return True
