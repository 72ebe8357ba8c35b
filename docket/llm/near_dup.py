"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A document is its set of five-word shingles, weighted by one plus the logarithm of how often the
shingle occurs in it, times an inverse document frequency between one and two. Improved consistent weighted sampling draws
``SAMPLES`` samples; two documents agree in a sample with a probability equal to their
weighted Jaccard similarity. Documents that agree in a whole band are candidates, and
candidates are verified by their exact weighted Jaccard similarity.

Document frequencies are counted over all documents, in a table of fixed size indexed by the
shingle's hash: shingles that share a place add up. The table is what is broadcast, whatever the corpus.

Classes without all pairs of a group: exact copies collapse to their smallest id by one
aggregation. The members of a bucket are compared by their samples in chunks of bounded size, inside a task. In
the first rounds each document hands on only the mate of another class that looks most similar;
those pairs are verified, and linked documents form classes. In the last round only buckets that still hold
several classes are compared, and every pair across classes that looks similar is verified where it is found. So no link
between different classes is left out for the size of a bucket, and pairs inside a class are not made.

Defined results: null and empty texts have no shingle and are a class of their own each; a
text of one to four words is one shingle; rows with a null id have no class; rows with equal ids
are one document; ties go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docket.llm.components import components
from docket.llm.words import bounded_batches, find_words, mix, pieces, shingle_hashes, span_hashes, text_bytes
from docket.session import staged

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 4
SAMPLES = 2 * BANDS * ROWS  # the second half only sharpens the comparison inside buckets
PLACES = 1 << 20
POOL = 1 << 16
PLAUSIBLE = 0.7
BEST_ROUNDS = 2
CHUNK = 2048


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct shingle, by row and hash."""
    data, offsets = text_bytes(column)
    starts, ends, rows = find_words(data, offsets, "space")
    words = span_hashes(data, starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(rows, np.arange(n + 1))
    size = np.diff(first)
    whole = shingle_hashes(words, SHINGLE)
    inside = rows[: len(whole)] == rows[SHINGLE - 1 :] if len(whole) else np.zeros(0, bool)
    row, value = rows[: len(whole)][inside], whole[inside]
    for r in np.flatnonzero((size > 0) & (size < SHINGLE)):
        few = words[first[r] : first[r + 1]]
        h = np.uint64(len(few))
        for w in few:
            h = mix(np.array([h ^ w]), 41)[0]
        row, value = np.append(row, r), np.append(value, h)
    key = (row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
    order = np.argsort(key)
    key, row, value = key[order], row[order], value[order]
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(key)))


def _place(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each place of the table, how many documents have a shingle there; and their number.

    A task adds up its own table. Tables meet in segments, first in about the square root of the
    tasks' number of groups, then in one: no group gets a row for each task. The result has ``PLACES`` numbers.
    """
    segment = PLACES // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, n = np.zeros(PLACES, np.int64), 0
        for batch in batches:
            for i, j in pieces(batch.column(0)):
                row, value, _ = shingles(batch.column(0)[i:j])
                total += np.bincount(_place(value), minlength=PLACES)
                n += len(np.unique(row))
        if n:
            small = total.astype(np.uint16) if total.max() < 1 << 16 else total
            cells = [small[s * segment : (s + 1) * segment].tobytes() for s in range(64)]
            group = TaskContext.get().partitionId() % max(1, int(tasks**0.5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(64), pa.int32()), pa.array([group] * 64, pa.int32()), pa.array([n] * 64, pa.int64()), pa.array(cells, pa.binary())],
                ["segment", "group", "n", "cells"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(segment, np.int64)
        for raw in table.column("cells"):
            raw = raw.as_py()
            total += np.frombuffer(raw, f"u{len(raw) // segment}").astype(np.int64)
        n = int(table.column("n").to_numpy().sum())
        return pa.table({"segment": table.column("segment")[:1], "n": pa.array([n]), "cells": pa.array([total.tobytes()], pa.binary())})

    texts = docs.select("text")
    tasks = texts.rdd.getNumPartitions()
    found = texts.mapInArrow(count, "segment int, group int, n long, cells binary")
    schema = "segment int, n long, cells binary"
    rows = found.groupBy("segment", "group").applyInArrow(add, schema).groupBy("segment").applyInArrow(add, schema).collect()
    table, n = np.zeros(PLACES, np.int64), 0
    for r in rows:
        table[r["segment"] * segment : (r["segment"] + 1) * segment] = np.frombuffer(bytes(r["cells"]), np.int64)
        n = r["n"]
    return table, n


def idf(counts: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequencies between one and two.

    In a large group of near copies the shared shingles are frequent and the edits are rare. The narrow
    range keeps such copies about as similar as by plain counts.
    """
    return (1 + np.log1p(n / np.maximum(counts, 1)) / max(1.0, np.log1p(n))).astype(np.float32)


def weight(table: np.ndarray, value: np.ndarray, count: np.ndarray) -> np.ndarray:
    """TF-IDF with a sublinear term frequency."""
    return (table[_place(value)] * (1 + np.log(count))).astype(np.float32)


class Sampler:
    """Consistent weighted samples. The random numbers of a shingle in sample ``j`` come from a
    pool, at a place that a multiply-shift hash of the shingle gives for ``j``."""

    def __init__(self, samples: int = SAMPLES) -> None:
        rng = np.random.default_rng(20_240_601)
        r = rng.gamma(2.0, 1.0, POOL).astype(np.float32)
        c = rng.gamma(2.0, 1.0, POOL)
        beta = rng.random(POOL).astype(np.float32)
        self.r, self.inverse, self.beta = r, (1 / r).astype(np.float32), beta
        # ln a = ln c - r (t - beta) - r
        self.base = (np.log(c) + r * beta - r).astype(np.float32)
        self.factors = mix(np.arange(samples, dtype=np.uint64), 51) | np.uint64(1)

    def samples(self, starts: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One row for each document (shingles from ``starts[i]`` on) and a column for each sample."""
        log = np.log(weight).astype(np.float32)
        place = np.arange(len(value), dtype=np.uint64)
        out = np.empty((len(starts), len(self.factors)), np.uint64)
        for j, factor in enumerate(self.factors):
            at = ((value * factor) >> np.uint64(48)).astype(np.int64)
            t = np.floor(log * self.inverse[at] + self.beta[at])
            a = self.base[at] - self.r[at] * t
            bits = a.view(np.int32).astype(np.int64)
            ordered = np.where(bits < 0, -(bits & 0x7FFFFFFF), bits) + (1 << 31)
            best = np.minimum.reduceat((ordered.astype(np.uint64) << np.uint64(32)) | place, starts)
            won = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
            out[:, j] = mix(value[won] ^ mix(t[won].astype(np.int64).view(np.uint64), 61), j)
        return out


SKETCH = "doc_id long, copy_a long, copy_b long, bands array<long>, samples binary"


def sketches(docs: DataFrame, table) -> DataFrame:
    """Samples, band keys and a 128-bit hash of the weighted set of every document that has a shingle."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, weights = Sampler(), table.value
        for batch in batches:
            for i, j in pieces(batch.column(1), 2 << 20):
                row, value, count = shingles(batch.column(1)[i:j])
                if not len(row):
                    continue
                starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                drawn = sampler.samples(starts, value, weight(weights, value, count))
                bands = np.zeros((len(starts), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = mix(bands ^ drawn[:, k : BANDS * ROWS : ROWS], 71)
                once = mix(value ^ (count.astype(np.uint64) << np.uint64(1)), 81)
                a, b = np.add.reduceat(mix(once, 1), starts), np.add.reduceat(mix(once, 2), starts)
                flat = pa.array(bands.view(np.int64).ravel())
                raw = (drawn & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j].take(pa.array(row[starts])),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat),
                        pa.array([r.tobytes() for r in raw], pa.binary()),
                    ],
                    ["doc_id", "copy_a", "copy_b", "bands", "samples"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(sketch, SKETCH)


def weighted_sets(docs: DataFrame, table) -> DataFrame:
    """(doc_id, members): shingle hashes of 32 bits and their weights, as two arrays in one cell."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = table.value
        for batch in batches:
            for i, j in pieces(batch.column(1), 2 << 20):
                row, value, count = shingles(batch.column(1)[i:j])
                if not len(row):
                    continue
                cuts = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row))
                heavy = weight(weights, value, count).astype("<f4")
                short = (value >> np.uint64(20)).astype("<u4")
                cells = []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    order = np.argsort(short[a:b], kind="stable")
                    cells.append(short[a:b][order].tobytes() + heavy[a:b][order].tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].take(pa.array(row[cuts[:-1]])), pa.array(cells, pa.binary())], ["doc_id", "members"])

    return docs.select("doc_id", "text").mapInArrow(gather, "doc_id long, members binary")


def weighted_jaccard(a: bytes, b: bytes) -> float:
    n, m = len(a) // 8, len(b) // 8
    x, wx = np.frombuffer(a, "<u4", n), np.frombuffer(a, "<f4", n, 4 * n)
    y, wy = np.frombuffer(b, "<u4", m), np.frombuffer(b, "<f4", m, 4 * m)
    at = np.minimum(np.searchsorted(y, x), m - 1)
    same = y[at] == x
    both = float(np.minimum(wx[same], wy[at[same]]).astype(np.float64).sum())
    return both / (float(wx.astype(np.float64).sum()) + float(wy.astype(np.float64).sum()) - both)


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (u, v) whose weighted Jaccard similarity, from ``weighted_sets``, is at least ``similar``."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("members").alias("a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("members").alias("b"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [weighted_jaccard(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], ["u", "v", "similarity"])

    joined = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return joined.mapInArrow(judge, "u long, v long, similarity double").where(F.col("similarity") >= similar)


def across(members: DataFrame, similar: float | None = None) -> DataFrame:
    """Pairs (u, v) of documents of one bucket, but different classes, that look similar.

    ``members``: band, key, doc_id, class, samples, and the bucket's size ``n``. A bucket is compared in
    chunks of about ``CHUNK`` documents; a task holds two chunks at a time. Without ``similar``, each
    document's most similar mate in a chunk. With it, ``members`` also has the weighted sets: every pair that looks
    similar is verified in the task, in the first band it shares, unless its classes are linked there already.
    """
    best = similar is None
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), chunks).cast("int")
    rows = (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id", "class", "samples", *([] if best else ["members"]))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def flush(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            band, key, low, high, own, ids, kind = (t.column(k).to_numpy() for k in range(7))
            drawn = np.frombuffer(b"".join(t.column(7).to_pylist()), "<u2").reshape(-1, SAMPLES)
            change = np.zeros(len(ids), bool)
            change[0] = True
            for k in (band, key, low, high):
                change[1:] |= k[1:] != k[:-1]
            cuts = np.append(np.flatnonzero(change), len(ids))
            who, mate, shares = [], [], []
            sets = None if best else t.column(8)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a < 2 or (kind[a:b] == kind[a]).all():
                    continue
                linked: dict[int, int] = {}

                def root(c: int) -> int:
                    while c in linked:
                        c = linked[c]
                    return c

                for r in range(a, b):
                    others = np.arange(a if best else r + 1, b)
                    others = others[kind[others] != kind[r]]
                    if low[a] != high[a]:
                        others = others[own[others] != own[r]]
                    if not len(others):
                        continue
                    equal = drawn[others] == drawn[r]
                    share = equal.mean(axis=1)
                    keep = share >= PLAUSIBLE
                    if best:
                        top = int(share.argmax())
                        keep &= np.arange(len(others)) == top
                    elif band[a]:
                        earlier = equal[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)[:, : band[a]].all(axis=2).any(axis=1)
                        keep &= ~earlier
                    if not best and keep.any():
                        mine, near = sets[r].as_py(), []
                        for k in np.flatnonzero(keep).tolist():
                            one, two = root(int(kind[r])), root(int(kind[others[k]]))
                            if one != two and weighted_jaccard(mine, sets[int(others[k])].as_py()) >= similar:
                                linked[max(one, two)] = min(one, two)
                                near.append(k)
                        keep = np.zeros(len(others), bool)
                        keep[near] = True
                    if keep.any():
                        who.append(np.full(int(keep.sum()), ids[r]))
                        mate.append(ids[others[keep]])
                        shares.append(share[keep])
            none = [np.zeros(0, np.int64)]
            w, m = np.concatenate(who or none), np.concatenate(mate or none)
            share = np.concatenate(shares or [np.zeros(0)])
            return pa.RecordBatch.from_arrays(
                [pa.array(w), pa.array(np.maximum(w, m)), pa.array(np.minimum(w, m)), pa.array(share)], ["who", "u", "v", "share"]
            )

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            last = [t.column(k)[-1].as_py() for k in range(4)]
            columns = [t.column(k).to_numpy() for k in range(4)]
            differs = np.zeros(t.num_rows, bool)
            for c, x in zip(columns, last):
                differs |= c != x
            begin = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if begin:
                yield flush(t.slice(0, begin))
            rest = t.slice(begin)
        if rest is not None:
            yield flush(rest)

    keys = ["band", "key", "low", "high"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(compare, "who long, u long, v long, share double")
    if best:
        found = found.groupBy("who").agg(F.max_by(F.struct("u", "v"), F.struct("share", -F.col("v"), -F.col("u"))).alias("p")).select("p.u", "p.v")
    return found.select("u", "v").distinct()


def broadcast_idf(spark: SparkSession, docs: DataFrame):
    counts, n = document_frequencies(docs)
    return spark.sparkContext.broadcast(idf(counts, n))


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id, n_copies) of every document; a class's id is its smallest document.

    ``n_copies`` is the number of documents with the same weighted set, itself included.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    table = broadcast_idf(spark, docs)
    drawn = staged(sketches(docs, table), "sketches")
    same = drawn.groupBy("copy_a", "copy_b").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    member = staged(drawn.select("doc_id", "copy_a", "copy_b").join(same, ["copy_a", "copy_b"]).select("doc_id", "first", "n_copies"), "copies")
    # One document stands for its copies; rows with one id are one document.
    one = drawn.join(member.where("doc_id = first").select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    one = staged(one.select("doc_id", "bands", "samples"), "distinct")
    bands = one.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bands = staged(bands.join(shared, ["band", "key"]).select("band", "key", "n", "doc_id"), "buckets")
    # The weighted sets of all documents in shared buckets, once for all rounds.
    asked = bands.select("doc_id").distinct().hint("shuffle_hash")
    sets = staged(weighted_sets(docs.select(F.col("doc_id").cast("long"), "text").join(asked, "doc_id", "left_semi"), table), "sets")
    links, linked = None, None
    for last in [False] * BEST_ROUNDS + [True]:
        kind = bands.withColumn("class", F.col("doc_id"))
        if linked is not None:
            kind = bands.join(linked, bands["doc_id"] == linked["node"], "left").select(*bands.columns, F.coalesce("component", "doc_id").alias("class"))
            kind = staged(kind, "kinds")
            mixed = kind.groupBy("band", "key").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("band", "key")
            kind = kind.join(mixed, ["band", "key"])
        members = kind.join(one.select("doc_id", "samples"), "doc_id")
        if last:
            found = across(members.join(sets, "doc_id"), similar)
        else:
            found = verified(staged(across(members), "pairs"), sets, similar).select("u", "v")
        links = staged(found if links is None else links.unionAll(found), "links")
        linked = components(links)
    found = member.join(linked, member["first"] == linked["node"], "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "first")).alias("class_id"), F.max("n_copies").alias("n_copies")
    )
    ids = docs.select(F.col("doc_id").cast("long"))
    return ids.join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")
    )
