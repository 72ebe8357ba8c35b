"""Connected components of an edge table by alternating stars.

Every step maps edges to edges: a node hands its neighbours the smallest id it sees. No component
is gathered anywhere; a node with many neighbours costs a partial minimum and a
join that Spark may split. Each round is written to the shared folder, so a lost
executor costs a re-read. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docket.session import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
    linked = both.join(least, both["u"] == least["w"])
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    handed = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
    return handed.unionAll(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); a component's id is its smallest node."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges, seen = staged(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state
        edges = staged(_star(_star(edges, True), False), "edges")
