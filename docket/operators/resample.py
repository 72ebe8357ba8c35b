"""Class balance: repeated rows, class weights and a stratified dummy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from docket import constants as C
from docket.functions.draws import hash_order, uniform
from docket.operators.order_stats import hash_statistics


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class."""
    everything = Window.partitionBy(F.lit(1))
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.select(
        label, "n", (F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))).alias("weight")
    )


def add_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Put the balanced weight on every row."""
    return df.join(F.broadcast(class_weights(df, label).select(label, F.col("weight").alias(name))), label)


def oversample_copies(df: DataFrame, key: str, label: str, seed=C.SEED, name: str = "copies") -> DataFrame:
    """Add how often each row occurs once every class has the largest class's size.

    Every row of a class of n rows gets floor(T/n) copies, and the first T mod n
    rows in hash order one more. The class sizes and the hash of each class's last
    extra row are looked up first; adding the copies is then a projection.
    """
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    largest = max(sizes.values(), default=0)
    extra = {c: largest % n for c, n in sizes.items() if largest % n}
    order = hash_order(key, seed)
    cuts = {}
    if extra:
        rank = F.lit(None).cast("bigint")
        for value, n in extra.items():
            rank = F.when(F.col("g") == value, n).otherwise(rank)
        short = df.filter(F.col(label).isin(list(extra)))
        cuts = {r["g"]: r["v"] for r in hash_statistics(short, F.col(label), order, lambda _: F.array(rank)).collect()}
    copies = F.lit(None).cast("int")
    for value, n in sizes.items():
        more = (order <= cuts[value]).cast("int") if value in cuts else F.lit(0)
        copies = F.when(F.col(label) == value, F.lit(largest // n) + more).otherwise(copies)
    return df.select(*df.columns, copies.alias(name))


def oversample(df: DataFrame, key: str, label: str, seed=C.SEED) -> DataFrame:
    """Repeat rows until every class has as many as the largest."""
    return (
        oversample_copies(df, key, label, seed, "__copies")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .drop("__copies")
    )


def dummy_predictions(df: DataFrame, key: str, label: str, seed=C.SEED, name: str = "prediction") -> DataFrame:
    """Predict 0 or 1 at random with the class shares; a seeded draw per key."""
    prior = df.agg(F.avg((F.col(label) == 0).cast("double")).alias("__zero"))
    draw = uniform(F.concat(F.col(key).cast("string"), F.lit(f":dummy:{seed}")))
    # The prior is one row; the constant key makes this an equi-join.
    return (
        df.withColumn("__one", F.lit(1))
        .join(F.broadcast(prior.withColumn("__one", F.lit(1))), "__one")
        .select(*df.columns, F.when(draw < F.col("__zero"), 0).otherwise(1).alias(name))
    )
