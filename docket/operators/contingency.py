"""Value counts of many columns in one pass: the table most operators start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*keep, feature, value)``, values as text, nulls kept."""
    wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "feature", "value")


def contingency(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(feature, value, *by, n)`` for all columns with one shuffle.

    Counts are combined before the shuffle, so a value that fills most of a
    column sends one row per task.
    """
    return long_values(df, columns, by).groupBy("feature", "value", *by).agg(F.count("*").alias("n"))


def class_counts(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Rows ``(feature, value, n0, n1)``: counts of a 0/1 label per value."""
    return (
        long_values(df, columns, [label])
        .groupBy("feature", "value")
        .agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per value of one column."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def distinct_counts(counts: DataFrame) -> DataFrame:
    """Rows ``(feature, n_rows, n_distinct, n_distinct_with_null)`` of a contingency table."""
    return counts.groupBy("feature").agg(
        F.sum("n").alias("n_rows"),
        F.count("value").alias("n_distinct"),
        F.count("*").alias("n_distinct_with_null"),
    )


def modes(counts: DataFrame, n: str = "n", by: str = "feature", keep_null: bool = False) -> DataFrame:
    """The most frequent value per group, the lowest on ties.

    Works on counted values, so no group's raw values meet in one buffer.
    """
    rows = counts if keep_null else counts.filter(F.col("value").isNotNull())
    lowest_first: Column = F.struct((-F.col(n)).alias("a"), F.col("value").alias("b"))
    return rows.groupBy(by).agg(
        F.min(lowest_first)["b"].alias("mode"), F.max(n).alias("mode_n")
    )


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of two columns together."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))
