"""Stratified folds without ranking a whole class in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docket import constants as C
from docket.functions.draws import hash_order
from docket.operators.order_stats import hash_statistics


def _tile_ends(total: Column, k: int) -> Column:
    """Last rank of the first k-1 of k even tiles, the longer tiles first."""
    size, extra = F.floor(total / k).cast("bigint"), total % k
    return F.array(*[(size * i + F.least(F.lit(i), extra)).cast("bigint") for i in range(1, k)])


def fold_cuts(df: DataFrame, key: str, label: str, k: int, seed=C.SEED) -> dict:
    """Per class, the hash of the last row of each fold but the final one: k-1 texts."""
    order = hash_order(key, seed)
    found = hash_statistics(df, F.col(label), order, lambda total: _tile_ends(total, k))
    rows = found.groupBy("g").agg(
        F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")
    )
    ends = F.transform(_tile_ends(F.col("total"), k), lambda r: F.col("at")[r])
    return {r["g"]: r["cuts"] for r in rows.select("g", ends.alias("cuts")).collect()}


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed=C.SEED, name: str = "fold") -> DataFrame:
    """Add a fold number 1..k that splits each class evenly in hash order.

    Rows do not move: the folds of a class are ranges of its key hash, found from
    bucket counts. What remains is a projection that compares a hash with k-1 texts.
    """
    cuts = F.lit(None).cast("array<string>")
    for value, texts in fold_cuts(df, key, label, k, seed).items():
        cuts = F.when(F.col(label) == value, F.lit(texts)).otherwise(cuts)
    place = F.lit(1)
    for i in range(k - 1):
        place = place + (F.col("__order") > F.get("__cuts", i)).cast("int")
    return df.withColumns({"__order": hash_order(key, seed), "__cuts": cuts}).select(*df.columns, place.alias(name))


def fold_sizes(df: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """Rows per fold and class."""
    return df.groupBy(fold, label).agg(F.count("*").alias("n"))
