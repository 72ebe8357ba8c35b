"""Look a value up in a table of any size, with any skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_VALUES = 1000
SPREAD = 1024
#: What a row of a broadcast table takes besides its text.
ROW_BYTES = 64


def look_up(
    df: DataFrame,
    table: DataFrame,
    column: str,
    out: str,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out``: what ``table(value, n, rows)`` has in ``n`` for ``column``, of any type; null where it has nothing.

    A small table is broadcast after its rows and bytes have been measured. A large one is
    split by ``rows``, how many rows of the data hold a value: values of more than one thousandth of all can be at
    most a thousand, so they are broadcast; the rest are joined by a shuffle in which rows
    that need no partner (hot, null) are spread evenly by ``spread_by``.
    """
    kept = df.columns
    sizes = table.agg(F.count("*"), F.sum(F.octet_length("value")), F.sum("rows")).first()
    if sizes[0] <= broadcast_rows and (sizes[1] or 0) + sizes[0] * ROW_BYTES <= BROADCAST_BYTES:
        side = F.broadcast(table.select(F.col("value").alias("__v"), F.col("n").alias("__n")))
        return df.join(side, F.col(column) == F.col("__v"), "left").select(*kept, F.col("__n").alias(out))
    limit = sizes[2] / HOT_VALUES
    hot = F.broadcast(table.filter(F.col("rows") > limit).select(F.col("value").alias("__hv"), F.col("n").alias("__hn")))
    cold = table.filter(F.col("rows") <= limit).select(
        F.col("value").alias("__v"), F.lit(-1).alias("__salt"), F.col("n").alias("__n")
    )
    settled = F.col(column).isNull() | F.col("__hv").isNotNull()
    salt = F.when(settled, F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int")).otherwise(-1)
    looked = df.join(hot, F.col(column) == F.col("__hv"), "left").withColumn("__s", salt)
    joined = looked.join(cold, (F.col(column).eqNullSafe(F.col("__v"))) & (F.col("__s") == F.col("__salt")), "left")
    return joined.select(*kept, F.coalesce("__hn", "__n").alias(out))


def lookup_number(
    df: DataFrame,
    numbers: DataFrame,
    column: str,
    out: str,
    spread_by: str,
    default: float = 0.0,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out``: the count ``n`` that ``numbers(value, n)`` gives for ``column``, else ``default``, as a double."""
    found = look_up(df, numbers.select("value", "n", F.col("n").alias("rows")), column, out, spread_by, broadcast_rows)
    return found.withColumn(out, F.coalesce(out, F.lit(default)).cast("double"))
