"""A case table of the prescribed shape, derived from order data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docket import constants as C
from docket.sources.tables import table


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: key, job title, flags with known behaviour, numerics, result."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
            F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
            F.min("l_shipdate").alias("first_ship"),
        )
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )

    def yes_no(condition):
        return F.when(condition, C.YES).otherwise(C.NO)

    no_lines = F.col("n_lines").isNull()
    n_lines = F.coalesce("n_lines", F.lit(0))
    returned = F.coalesce("n_r", F.lit(0)) > 0
    favourable = (returned & (n_lines >= 3)) != (F.col("o_orderkey") % 10 == 0)
    priority = F.col("o_orderpriority")
    return joined.select(
        F.col("o_orderkey").alias(C.KEY),
        F.col("c_mktsegment").alias("cargo"),
        (F.col("c_nationkey") % 2 == 0).alias("vt"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string")).alias("matricula"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("ultima_remuneracao"),
        F.datediff("first_ship", "o_orderdate").alias("tempo_cargo"),
        F.when(no_lines, C.INVALID).otherwise(yes_no(returned)).alias("prova_1"),
        F.when(no_lines, C.INVALID).otherwise(yes_no(F.col("n_a") > 0)).alias("prova_2"),
        yes_no(n_lines >= 4).alias("prova_3"),
        yes_no(F.col("o_totalprice") > 480000).alias("prova_4"),
        F.when(no_lines, C.INVALID).otherwise(C.YES).alias("prova_5"),
        F.lit(C.NO).alias("prova_6"),
        F.when(priority != "4-NOT SPECIFIED", yes_no(priority.isin("1-URGENT", "2-HIGH"))).alias("prova_7"),
        F.when(F.col("o_orderkey").isin(3, 7, 11), "PARCIAL")
        .otherwise(yes_no(F.col("o_orderkey") % 2 == 0))
        .alias("prova_8"),
        F.when(favourable, "FAVORAVEL").otherwise("DESFAVORAVEL").alias(C.TARGET),
    )
