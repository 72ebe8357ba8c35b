"""Columns to leave out because one value rules them or too many values fill them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docket import constants as C
from docket.operators.contingency import contingency, distinct_counts
from docket.schema import Roles

VERDICTS = "feature string, rule string, dropped boolean"
#: Items that a column's heavy-hitter summary returns and tracks. A value of more than half of the rows is among them; nulls may be one more.
TOP, TRACKED = 2, 64


def low_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its counts, the rule that drops it and the verdict.

    Rules apply in order. Distinct counts take the invalid marker as a value and
    leave out nulls; shares and the rarest count look at valid values only.
    """
    counts = contingency(df, columns)
    value, n = F.col("value"), F.col("n")
    valid = F.when(value != C.INVALID, n)
    facts = counts.groupBy("feature").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(valid), F.lit(0)).alias("n_valid"),
        F.max(valid).alias("top_n"),
        F.min(valid).alias("rarest_n"),
        F.coalesce(F.bool_or(value == C.INVALID), F.lit(False)).alias("has_invalid"),
        F.coalesce(F.bool_or(value == C.YES), F.lit(False)).alias("has_yes"),
    )
    share = F.col("top_n") / F.col("n_valid")
    rule = (
        F.when(F.col("n_distinct") == 0, "all_null")
        .when(F.col("n_distinct") == 1, "constant")
        .when((F.col("n_distinct") == 2) & F.col("has_invalid"), "one_valid_value")
        .when(share > C.DOMINANT_SHARE, "dominant_value")
        .when(F.col("has_yes") & (F.col("rarest_n") < C.RAREST_MIN_ROWS), "rare_value")
        .otherwise("keep")
    )
    return facts.select(
        "feature",
        "n_distinct",
        "n_valid",
        F.when(F.col("n_valid") > 0, share).alias("top_share"),
        "rarest_n",
        rule.alias("rule"),
        (rule != "keep").alias("dropped"),
    )


def screen_rules(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(feature, rule, dropped)``: the verdicts of :func:`low_variance` without its counts.

    One aggregate of bounded summaries settles most rules: extremes tell one value from more, and a value of more than
    half of the rows is among the few that a heavy-hitter summary tracks. Such values are then counted in a second
    scan. Values are only counted one by one in columns that hold the favourable marker and do not have so
    many values that one of them must be rare. So a column of unique values sends none of them through a shuffle.
    """
    columns = list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], VERDICTS)
    text = {c: F.col(c).cast("string") for c in columns}
    valid = {c: F.when(t != C.INVALID, t) for c, t in text.items()}

    def summary(c: str) -> Column:
        top = F.call_function("approx_top_k", valid[c], F.lit(TOP), F.lit(TRACKED))
        return F.struct(
            F.min(text[c]).alias("low"), F.max(text[c]).alias("high"), F.count(valid[c]).alias("n_valid"),
            F.min(valid[c]).alias("valid_low"), F.max(valid[c]).alias("valid_high"),
            F.coalesce(F.bool_or(text[c] == C.YES), F.lit(False)).alias("has_yes"),
            F.transform(F.filter(top, lambda t: t["item"].isNotNull()), lambda t: F.struct(t["item"].alias("value"), t["count"].alias("n"))).alias("top"),
            F.hll_sketch_estimate(F.hll_sketch_agg(text[c], F.lit(12))).alias("distinct"),
        ).alias(c)

    facts = df.agg(*[summary(c) for c in columns]).first()
    rule: dict[str, str] = {}
    likely: dict[str, str] = {}
    for c in columns:
        f = facts[c]
        if f["low"] is None:
            rule[c] = "all_null"
        elif f["low"] == f["high"]:
            rule[c] = "constant"
        elif f["valid_low"] == f["valid_high"]:
            # More than one value and one valid one: the other is the marker.
            rule[c] = "one_valid_value"
        elif f["top"] and f["top"][0]["n"] > f["n_valid"] / 2:
            likely[c] = f["top"][0]["value"]
    if likely:
        counted = df.agg(*[F.count_if(text[c] == v).alias(c) for c, v in likely.items()]).first()
        rule |= {c: "dominant_value" for c in likely if counted[c] / facts[c]["n_valid"] > C.DOMINANT_SHARE}
    marked = [c for c in columns if c not in rule and facts[c]["has_yes"]]
    # With more values than a fifth of the rows, one has fewer than five; the margin covers the sketch's error.
    many = [c for c in marked if facts[c]["distinct"] * 0.8 - 1 > facts[c]["n_valid"] / C.RAREST_MIN_ROWS]
    rule |= {c: "rare_value" for c in many}
    if few := [c for c in marked if c not in many]:
        rarest = contingency(df, few).where(F.col("value") != C.INVALID).groupBy("feature").agg(F.min("n").alias("n"))
        rule |= {r["feature"]: "rare_value" for r in rarest.where(F.col("n") < C.RAREST_MIN_ROWS).collect()}
    rows = [(c, rule.get(c, "keep"), c in rule) for c in columns]
    return df.sparkSession.createDataFrame(rows, VERDICTS)


def flagged(report: DataFrame) -> list[str]:
    """Names of the dropped columns; the report has one row per column."""
    return [r["feature"] for r in report.filter("dropped").select("feature").collect()]


def drop_low_variance(df: DataFrame, roles: Roles = Roles(), scope: str = "categorical") -> tuple[DataFrame, list[str]]:
    """Drop the flagged columns; ``scope="all"`` tests key, numerics and target too."""
    names = flagged(screen_rules(df, df.columns if scope == "all" else roles.categorical(df)))
    return df.drop(*names), [c for c in df.columns if c in names]


def high_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts and ratios, and whether the ratio passes the limit."""
    ratio = F.col("n_distinct") / F.col("n_rows")
    return distinct_counts(contingency(df, columns)).select(
        "feature", "n_rows", "n_distinct", ratio.alias("ratio"), (ratio > C.HIGH_CARD_RATIO).alias("high_card")
    )


def column_kinds(
    df: DataFrame, columns: Sequence[str], ratio: float = C.HIGH_CARD_RATIO, max_nominal: int = C.MAX_NOMINAL
) -> tuple[list[str], list[str], list[str]]:
    """Columns to encode by frequency, by dictionary and by a list of their values.

    The first have more than ``ratio`` distinct values for each row, the second more than ``max_nominal``
    values, the third are the rest. One pass of sketches settles the clear cases; only columns near a limit are
    counted exactly.
    """
    columns = list(columns)
    if not columns:
        return [], [], []
    # A sketch of 4096 registers errs by 1.6 percent; the margin is twelve times that.
    distinct = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(12)))
    sketch = df.agg(F.count("*").alias("__rows"), *[distinct(c).alias(c) for c in columns]).first()
    rows = max(sketch["__rows"], 1)
    kind = lambda n: 0 if n / rows > ratio else 1 if n > max_nominal else 2
    near = [c for c in columns if kind((sketch[c] or 0) * 1.2) != kind((sketch[c] or 0) * 0.8)]
    exact = {}
    if near:
        exact = {r["feature"]: r["n_distinct"] for r in distinct_counts(contingency(df, near)).collect()}
    kinds = {c: kind(exact.get(c, sketch[c] or 0)) for c in columns}
    return tuple([c for c in columns if kinds[c] == k] for k in range(3))


def high_card_columns(df: DataFrame, columns: Sequence[str], ratio: float = C.HIGH_CARD_RATIO) -> list[str]:
    """Columns to encode by frequency, decided exactly by the ratio of distinct values to rows."""
    return column_kinds(df, columns, ratio)[0]


def columns_with_value(df: DataFrame, columns: Sequence[str], value: str = C.INVALID) -> DataFrame:
    """One row per column: whether the value occurs in it."""
    tests = [F.coalesce(F.bool_or(F.col(c).cast("string") == value), F.lit(False)).alias(c) for c in columns]
    return df.agg(*tests).unpivot([], list(columns), "feature", "present")
