"""Exact top-k inner products by columnar branch and bound.

Candidates lie in vertical blocks: one row of a matrix for each dimension. A query
adds up products a block of dimensions at a time. After each block a candidate's best
possible score is what it has plus the product of the norms that remain (Cauchy-Schwarz);
candidates that cannot reach the query's k-th best known score leave the block, and the
rest are compacted. Nothing is estimated: the result is exact, ties go to the smaller id.

Candidates are dealt to groups by hash of their id; a group is held by one task and has
about ``group_rows`` vectors. Every group sees the queries once, and hands k rows for each
to the merge. The query set is a stated set; it streams through a task in batches.

Defined results: vectors that are null, empty, or hold null or non-finite components take
no part, nor do rows without an id; only vectors of equal length are compared; rows with
the query's own id are not its candidates; equal rows are as many candidates; an empty
table gives no rows. Scores are exact while they are below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docket.llm.words import bounded_batches

RESULT = "query_id long, vec_id long, score long"


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component, null for a vector that takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double")))


class Block:
    """The candidates of one group with one vector length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, step: int = 16) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.columns = ids[order], np.ascontiguousarray(vectors[order].T)
        self.cuts = [*range(0, len(self.columns), step), len(self.columns)]
        squares = np.cumsum((self.columns**2)[::-1], axis=0)[::-1]
        self.rest = [np.sqrt(squares[c]) if c < len(self.columns) else np.zeros(len(ids)) for c in self.cuts]

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates, best first."""
        alive = np.flatnonzero(self.ids != own)
        done = np.zeros(len(alive))
        bound = -np.inf
        for b, (low, high) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            block = self.columns[low:high]
            done = done + query[low:high] @ (block if len(alive) == block.shape[1] else block[:, alive])
            if high == len(query):
                break
            if b == 0 and len(alive) > 4 * k:
                # Finish the most promising few: their k-th best score is a bound that holds.
                few = np.argpartition(-done, 4 * k)[: 4 * k]
                full = done[few] + query[high:] @ self.columns[high:, alive[few]]
                bound = np.partition(full, -k)[-k]
            mass = float(np.sqrt((query[high:] ** 2).sum()))
            keep = done + mass * self.rest[b + 1][alive] * (1 + 1e-9) + 1e-6 >= bound
            if not keep.all():
                alive, done = alive[keep], done[keep]
        if len(alive) > k:
            # Everything that ties with the k-th stays until the ids decide.
            floor = np.partition(done, -k)[-k]
            keep = done >= floor
            alive, done = alive[keep], done[keep]
        order = np.lexsort((self.ids[alive], -done))[:k]
        return self.ids[alive][order], done[order]


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, group_rows: int = 16_384) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best candidates.

    Both inputs have columns ``vec_id`` and ``vector`` (from ``quantised``).
    """
    vectors, queries = (
        t.select(F.col("vec_id").cast("long"), "vector").where("vec_id is not null and vector is not null") for t in (vectors, queries)
    )
    groups = max(1, -(-vectors.count() // group_rows))
    sides = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("side"), "vec_id", "vector"
    ).unionAll(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("side"), "vec_id", "vector")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, blocks = None, [], None
        for batch in batches:
            g, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids, lists = batch.column(2).to_numpy(), batch.column(3)
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            change = (np.flatnonzero((np.diff(g) != 0) | (np.diff(side) != 0)) + 1).tolist()
            for i, j in zip([0, *change], [*change, len(g)]):
                if g[i] != group:
                    group, parts, blocks = g[i], [], None
                size = np.diff(ends[i : j + 1])
                if side[i] == 0:
                    for d in np.unique(size):
                        rows = i + np.flatnonzero(size == d)
                        parts.append((int(d), ids[rows], flat[ends[rows][:, None] + np.arange(d)]))
                    continue
                if blocks is None:
                    blocks = {
                        d: Block(np.concatenate([p[1] for p in parts if p[0] == d]), np.concatenate([p[2] for p in parts if p[0] == d]))
                        for d in {p[0] for p in parts}
                    }
                    parts = []
                for r in range(i, j):
                    vector = flat[ends[r] : ends[r + 1]]
                    if len(vector) in blocks:
                        found, score = blocks[len(vector)].best(ids[r], vector, k)
                        out.append((np.full(len(found), ids[r]), found, score))
            if out:
                q, v, s = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s.astype(np.int64))], ["query_id", "vec_id", "score"])

    bounded_batches(vectors.sparkSession)
    near = sides.repartition("g").sortWithinPartitions("g", "side", "vec_id").mapInArrow(search, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
