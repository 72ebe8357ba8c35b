"""Exact order statistics without sorting a whole group in one task.

The value range of every group is cut into many buckets. Counting the buckets
tells which one holds each wanted rank. A bucket of one value is the answer, a small one is
ranked, and a large one is cut into buckets again, by quantiles of its own or by further digits, until it is
one of the two. All counts combine on the map side, so equal values never pile up, and no task
ranks more than a stated number of rows, whatever their number and skew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

HASH_DIGITS = 4
#: The rows of a bucket that one task may rank.
RANKED_ROWS = 100_000
#: Cuts by which a large bucket of numbers is parted, and the accuracy of the sketch that finds them.
FINER_CUTS, FINER_ACCURACY = 255, 2000

#: Parts a bucket's rows ``(spot, v)`` again: adds ``b``, which grows with ``v``. The second argument counts the levels.
Finer = Callable[[DataFrame, int], DataFrame]


def finer_numbers(rows: DataFrame, level: int) -> DataFrame:
    """Buckets between a spot's own approximate quantiles; each of these values has a bucket of its own."""
    probs = F.array(*[F.lit(i / (FINER_CUTS + 1)) for i in range(1, FINER_CUTS + 1)])
    cuts = rows.groupBy("spot").agg(F.array_distinct(F.percentile_approx("v", probs, FINER_ACCURACY)).alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    is_cut = F.array_contains("cuts", F.col("v")).cast("int")
    return rows.join(F.broadcast(cuts), "spot").withColumn("b", below * 2 + is_cut).drop("cuts")


def finer_digits(rows: DataFrame, level: int) -> DataFrame:
    """Buckets by the first digits of a text, more of them at each level."""
    return rows.withColumn("b", F.substring("v", 1, HASH_DIGITS * (level + 1)))


def _buckets(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by, "b").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def _spots(hist: DataFrame, by: str, wanted: DataFrame) -> list:
    """The buckets ``b`` of each group ``by`` that hold a wanted rank: rows before, rows in them, least and largest value, ranks.

    ``wanted`` has ``(by, total, rank)``, one row for each rank.
    """
    upto = F.sum("n").over(Window.partitionBy(by).orderBy("b"))
    placed = hist.select(by, "n", "low", "high", (upto - F.col("n")).alias("before"), upto.alias("upto"), "b")
    # One row for each wanted rank at most, whatever the rows.
    return (
        placed.join(F.broadcast(wanted), by)
        .filter("rank > before and rank <= upto")
        .groupBy(by, "b")
        .agg(*[F.first(c).alias(c) for c in ("before", "total", "n", "low", "high")], F.collect_list("rank").alias("ranks"))
        .collect()
    )


def order_statistics(
    df: DataFrame,
    group: Column,
    value: Column,
    bucket: Column,
    ranks: Callable[[Column], Column],
    finer: Finer = finer_numbers,
    largest: int = RANKED_ROWS,
) -> DataFrame:
    """Rows ``(g, total, rank, v)``: the value at each wanted 1-based rank of each group.

    ``bucket`` must grow with ``value``. ``ranks`` maps the group's row count to
    an array of ranks. Rows with a null value are left out. A bucket that holds a wanted rank and more than
    ``largest`` rows of several values is parted by ``finer``.
    """
    spark = df.sparkSession
    keyed = df.select(group.alias("g"), value.alias("v"), bucket.alias("b")).filter("g is not null and v is not null")
    kind = {f.name: f.dataType for f in keyed.schema.fields}
    hist = _buckets(keyed, "g")
    totals = hist.groupBy("g").agg(F.sum("n").alias("total"))
    wanted = totals.select("g", "total", F.explode(F.array_distinct(ranks(F.col("total")))).alias("rank"))
    spots = [(r["g"], r["total"], r["before"], r["n"], r["low"], r["high"], r["ranks"]) for r in _spots(hist, "g", wanted)]
    shape = T.StructType(
        [
            T.StructField("spot", T.LongType()), T.StructField("g", kind["g"]), T.StructField("total", T.LongType()),
            T.StructField("before", T.LongType()), T.StructField("n", T.LongType()), T.StructField("low", kind["v"]),
            T.StructField("high", kind["v"]), T.StructField("ranks", T.ArrayType(T.LongType())),
        ]
    )

    def inside(chosen: list, *more: str) -> DataFrame:
        """The rows of some spots; a spot is the range of its values."""
        table = F.broadcast(spark.createDataFrame([(i, *s) for i, s in enumerate(chosen)], shape).withColumnRenamed("g", "__g"))
        held = (F.col("g") == F.col("__g")) & F.col("v").between(F.col("low"), F.col("high"))
        return keyed.join(table, held).select("spot", "v", *more)

    found, small, level = [], [], 0
    while spots:
        large = []
        for s in spots:
            g, total, _, n, low, high, places = s
            if low == high:
                found += [(g, total, rank, low) for rank in places]
            else:
                (small if n <= largest else large).append(s)
        if not large:
            break
        level += 1
        places = [(i, s[1], rank - s[2]) for i, s in enumerate(large) for rank in s[6]]
        parted = _spots(_buckets(finer(inside(large), level), "spot"), "spot", spark.createDataFrame(places, "spot long, total long, rank long"))
        spots = []
        for r in parted:
            g, total, before, *_ = large[r["spot"]]
            spots.append((g, total, before + r["before"], r["n"], r["low"], r["high"], [before + k for k in r["ranks"]]))
    out = T.StructType([shape["g"], shape["total"], T.StructField("rank", T.LongType()), T.StructField("v", kind["v"])])
    settled = spark.createDataFrame(found, out)
    if not small:
        return settled
    ranked = (
        inside(small, "g", "total", "before", "ranks")
        .groupBy("spot", "v")
        .agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("g", "total", "before", "ranks")])
        .withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("spot").orderBy("v")))
        .withColumn("rank", F.explode(F.expr("filter(ranks, r -> r > upto - n and r <= upto)")))
    )
    return settled.unionByName(ranked.select("g", "total", "rank", "v"))


def hash_statistics(df: DataFrame, group: Column, order: Column, ranks: Callable[[Column], Column]) -> DataFrame:
    """Order statistics of a hex hash; its first digits are the buckets."""
    return order_statistics(df, group, order, F.substring(order, 1, HASH_DIGITS), ranks, finer_digits)


def _approximate_splits(df: DataFrame, columns: Sequence[str], buckets: int) -> list[list[float]]:
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
        list(columns), probs, 1.0 / (2 * buckets)
    )
    ends = (float("-inf"), float("inf"))
    return [[ends[0], *(sorted(set(c)) or [0.0]), ends[1]] for c in cuts]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    interpolate: bool = True,
    buckets: int = 256,
    largest: int = RANKED_ROWS,
) -> DataFrame:
    """Rows ``(feature, prob, value)`` with exact quantiles of numeric columns.

    With ``interpolate`` the value lies between the two neighbouring rows; without
    it, it is the row at rank ceil(prob * n).
    """
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    bucketed = Bucketizer(
        splitsArray=_approximate_splits(df, columns, buckets),
        inputCols=columns,
        outputCols=[f"{c}__bucket" for c in columns],
        handleInvalid="keep",
    ).transform(numbers)
    long = bucketed.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).alias("x"), F.col(f"{c}__bucket").alias("bucket"))
                    for c in columns
                ]
            )
        )
    )
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if interpolate:
        def ranks(total):
            spot = lambda p: (total - 1) * p + 1
            return F.concat(
                F.transform(wanted, lambda p: F.floor(spot(p)).cast("bigint")),
                F.transform(wanted, lambda p: F.ceil(spot(p)).cast("bigint")),
            )
    else:
        def ranks(total):
            return F.transform(wanted, lambda p: F.greatest(F.ceil(total * p), F.lit(1)).cast("bigint"))

    found = order_statistics(long, F.col("feature"), F.col("x"), F.col("bucket"), ranks, finer_numbers, largest)
    by_feature = (
        found.groupBy("g")
        .agg(F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
        .withColumn("prob", F.explode(wanted))
    )
    if interpolate:
        spot = (F.col("total") - 1) * F.col("prob") + 1
        low = F.col("at")[F.floor(spot).cast("bigint")]
        high = F.col("at")[F.ceil(spot).cast("bigint")]
        value = low + (spot - F.floor(spot)) * (high - low)
    else:
        value = F.col("at")[F.greatest(F.ceil(F.col("total") * F.col("prob")), F.lit(1)).cast("bigint")]
    return by_feature.select(F.col("g").alias("feature"), "prob", value.alias("value"))


def global_index(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Add the 0-based place of every row in a total order.

    Rows are range-partitioned and sorted by Spark; only one count per partition
    is summed up. The sorted rows are checkpointed, so both uses see one layout.
    """
    from docket.session import working_dir

    working_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("__part", F.shiftright("__at", 33)).withColumn(
        "__in_part", F.col("__at").bitwiseAND((1 << 33) - 1)
    )
    parts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = parts.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start")
    )
    return (
        placed.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__in_part"))
        .drop("__at", "__part", "__in_part", "__start")
    )
