"""Profile of a table: one row per column, duplicates and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from docket.operators.contingency import contingency
from docket.operators.order_stats import exact_quantiles

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _long_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "x")


def numeric_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, moments and extremes of numeric columns in one aggregation.

    Skewness and kurtosis carry the small-sample correction.
    """
    x, n = F.col("x"), F.col("n")
    facts = _long_numbers(df, columns).groupBy("feature").agg(
        F.count("*").alias("n_rows"),
        F.count("x").alias("n"),
        F.count_distinct("x").alias("n_distinct"),
        F.count_if(x == 0).alias("n_zeros"),
        F.count_if(x < 0).alias("n_negative"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.sum("x").alias("total"),
        F.skewness("x").alias("g1"),
        F.kurtosis("x").alias("g2"),
    )
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1.0)) / (n - 2))
    kurt = F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * F.col("g2") + 6))
    return facts.select(
        "feature",
        "n_rows",
        (F.col("n_rows") - n).alias("n_missing"),
        "n_distinct",
        "n_zeros",
        "n_negative",
        "mean",
        "std",
        "min",
        "max",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("std") / F.col("mean")).alias("cv"),
        "total",
        skew.alias("skewness"),
        kurt.alias("kurtosis"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments with exact quartiles and tail quantiles."""
    cuts = exact_quantiles(df, columns, QUANTILES)
    names = [f"q{round(p * 100):02d}" for p in QUANTILES]
    wide = cuts.groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in zip(QUANTILES, names)]
    )
    joined = numeric_moments(df, columns).join(wide, "feature", "left")
    return joined.withColumn("iqr", F.col("q75") - F.col("q25"))


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, lengths and the most frequent value of text columns."""
    value, n = F.col("value"), F.col("n")
    known = F.when(value.isNotNull(), n)
    top = F.min(F.when(value.isNotNull(), F.struct((-n).alias("a"), value.alias("b"))))
    return (
        contingency(df, columns)
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("n_missing"),
            F.count("value").alias("n_distinct"),
            F.count_if(value.isNotNull() & (n == 1)).alias("n_unique"),
            top.alias("top"),
            F.min(F.length("value")).alias("min_length"),
            F.max(F.length("value")).alias("max_length"),
            (F.sum(F.length("value") * n) / F.sum(known)).alias("mean_length"),
        )
        .select(
            "feature",
            "n_rows",
            "n_missing",
            "n_distinct",
            "n_unique",
            F.col("top.b").alias("top_value"),
            (-F.col("top.a")).alias("top_n"),
            "min_length",
            "max_length",
            "mean_length",
        )
    )


def frequent_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values per column.

    The rank filter on ``row_number`` lets Spark prune each task to k rows per
    column before the shuffle.
    """
    best = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("value"))
    return (
        contingency(df, columns)
        .filter(F.col("value").isNotNull())
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts in equal-width bins between each column's extremes."""
    long = _long_numbers(df, columns).filter("x is not null")
    # One row per column.
    ends = F.broadcast(long.groupBy("feature").agg(F.min("x").alias("low"), F.max("x").alias("high")))
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        long.join(ends, "feature")
        .groupBy("feature", place.cast("int").alias("bin"), "low", "high")
        .agg(F.count("*").alias("n"))
        .select("feature", "bin", (F.col("low") + F.col("bin") * width).alias("bin_start"), "n")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat another row on the given columns, or on all of them.

    Fingerprints of 128 bits are counted first. A fingerprint that occurs once is a row of its own; whole rows are
    compared only where a fingerprint repeats, so what is shuffled does not grow with the width of rows that do not.
    """
    names = list(columns or df.columns)
    marked = df.select(*names, F.xxhash64(*names).alias("__p"), F.xxhash64(F.lit(1), *names).alias("__q"))
    prints = marked.groupBy("__p", "__q").agg(F.count("*").alias("__n"))
    repeated = marked.join(prints.where("__n > 1").select("__p", "__q"), ["__p", "__q"], "left_semi")
    n = F.col("__n")
    of = lambda groups: groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct_rows"),
        F.count_if(n > 1).alias("n_repeated"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("n_duplicates"),
    )
    parts = of(prints.where("__n = 1")).unionByName(of(repeated.groupBy(*names).agg(F.count("*").alias("__n"))))
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
