"""Which flags push a case towards a favourable result, from any attribution table.

The input has rows ``(key, feature, value, contribution)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from docket import constants as C
from docket.operators.screen import columns_with_value


def value_totals(attributions: DataFrame) -> DataFrame:
    """Rows ``(feature, value, n, n_pos, n_neg, sum_abs)``: the one pass over the attributions.

    Everything below works on these few rows, so no feature's rows meet in one task.
    A column ``n`` in the input says for how many cases a row stands.
    """
    contribution = F.col("contribution")
    cases = F.col("n") if "n" in attributions.columns else F.lit(1)
    counted = lambda condition: F.sum(F.when(condition, cases).otherwise(0))
    return attributions.groupBy("feature", "value").agg(
        F.sum(cases).alias("n"),
        counted(contribution > 0).alias("n_pos"),
        counted(contribution < 0).alias("n_neg"),
        F.sum(F.abs(contribution) * cases).alias("sum_abs"),
    )


def global_importance(totals: DataFrame) -> DataFrame:
    """Rows ``(place, feature, importance)``: mean absolute contribution, highest first."""
    means = totals.groupBy("feature").agg((F.sum("sum_abs") / F.sum("n")).alias("importance"))
    # One row per feature.
    order = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return means.select(F.row_number().over(order).alias("place"), "feature", "importance")


def favourable_values(totals: DataFrame) -> DataFrame:
    """Rows ``(feature, value_pos, value_neg)``: the usual value among rows each way.

    The lowest value wins ties, a missing one first. A feature that never pushes
    in one of the two directions is left out.
    """

    def usual(n: str):
        entry = F.when(F.col(n) > 0, F.struct((-F.col(n)).alias("a"), F.col("value").alias("b")))
        return F.min(entry)["b"]

    facts = totals.groupBy("feature").agg(
        usual("n_pos").alias("value_pos"),
        usual("n_neg").alias("value_neg"),
        F.sum("n_pos").alias("n_pos"),
        F.sum("n_neg").alias("n_neg"),
    )
    return facts.filter("n_pos > 0 and n_neg > 0").select("feature", "value_pos", "value_neg")


def impact_by_value(value) -> F.Column:
    """Positive if the favourable value is yes, negative if it is no or invalid."""
    return F.when(value == C.YES, C.POSITIVE).when(value.isin(C.NO, C.INVALID), C.NEGATIVE)


def impact_by_code(code, has_invalid) -> F.Column:
    """The same verdict from sorted codes: 2 positive, 0 negative, 1 by the invalid marker."""
    return (
        F.when(code == 2, C.POSITIVE)
        .when(code == 0, C.NEGATIVE)
        .when((code == 1) & has_invalid, C.NEGATIVE)
        .when(code == 1, C.POSITIVE)
    )


def impact_labels(df: DataFrame, favourable: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(feature, value_pos, has_invalid, impact)`` for the columns of a case table."""
    marked = columns_with_value(df, columns).withColumnRenamed("present", "has_invalid")
    return favourable.join(F.broadcast(marked), "feature").select(
        "feature", "value_pos", "has_invalid", impact_by_value(F.col("value_pos")).alias("impact")
    )


def evidence_table(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(place, provas, value_importance, impacto)`` for evidence columns, best first."""
    wanted = F.col("feature").isin(list(columns))
    importance = global_importance(totals).filter(wanted)
    favourable = favourable_values(totals.filter(wanted))
    joined = importance.join(F.broadcast(favourable), "feature")
    order = Window.orderBy("place")
    return joined.select(
        F.row_number().over(order).alias("place"),
        F.col("feature").alias("provas"),
        F.col("importance").alias("value_importance"),
        impact_by_value(F.col("value_pos")).alias("impacto"),
    )


def evidence_texts(evidence: DataFrame) -> DataFrame:
    """One row of three printed maps by place, for callers that want evidence as text."""
    from docket.functions.text import map_text

    # A map's text would lose a null entry, so a missing verdict travels as empty text.
    evidence = evidence.fillna({"impacto": ""})
    entry = lambda c: F.collect_list(F.struct((F.col("place") - 1).alias("k"), F.col(c).alias("v")))
    return evidence.agg(
        map_text(entry("provas")).alias("provas"),
        map_text(entry("value_importance")).alias("value_importance"),
        map_text(entry("impacto")).alias("impacto"),
    )


def with_evidence(scored: DataFrame, evidence: DataFrame) -> DataFrame:
    """The printed evidence beside every scored row; the text is a single row."""
    texts = F.broadcast(evidence_texts(evidence).withColumn("__one", F.lit(1)))
    return scored.withColumn("__one", F.lit(1)).join(texts, "__one").drop("__one")


def evidence_from_texts(texts: DataFrame) -> DataFrame:
    """Rows ``(place, provas, value_importance, impacto)`` read back from one row of texts.

    Every entry comes back, the last one included.
    """
    from docket.functions.text import bare_values, quoted_values

    entry = F.posexplode(
        F.arrays_zip(
            quoted_values(F.col("provas")).alias("provas"),
            bare_values(F.col("value_importance")).alias("value_importance"),
            quoted_values(F.col("impacto")).alias("impacto"),
        )
    )
    return texts.select(entry).select(
        (F.col("pos") + 1).alias("place"),
        "col.provas",
        F.col("col.value_importance").cast("double").alias("value_importance"),
        F.nullif(F.col("col.impacto"), F.lit("")).alias("impacto"),
    )
