"""Pack documents into as few sequences as possible by a plan over their lengths.

Pieces of equal length are alike, so the plan needs the histogram of lengths only: a few thousand numbers,
however many documents there are. A mixture is a multiset of lengths that fits into one sequence. The
linear program asks for the least number of sequences, each filled by some mixture, that holds every length as often
as it occurs. It is solved by multiplicative weights (:func:`solve`): a length's price falls exponentially with the
share of it that is already placed; a knapsack by dynamic programming finds, for every length, the dearest mixture
that holds it at these prices; mixtures are taken in small shares. The shares are rounded (:func:`rounded`) to whole
sequences as far as the stock of lengths goes, and the few pieces left over are placed best-fit, first into gaps.

Each document is encoded where it lies. The place of a piece among all of its length is its place within its
partition plus the counts of the partitions before it, so that neither texts nor ids are sorted; the plan turns this
place into a sequence and an offset.

Defined results: a null or empty text is its end id alone; null ids and other columns do not matter; repeated rows are
packed as often as they occur; an empty table gives no pieces; only documents longer than the window are cut, into full
windows and a rest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docket.llm.encode import encoder, with_end
from docket.llm.words import bounded_batches, pieces, text_bytes
from docket.session import staged

#: A length's price is this power of it, since long pieces are harder to place; it falls by this power of e while the
#: length goes from unplaced to placed.
POWER, FALL = 2.0, 0.3
#: The share of a length that one round places at most, and the rounds that are made at most.
SHARE, ROUNDS = 0.5, 400
#: Among mixtures within this share of the best price, one is drawn, so that rounds use many.
SPREAD = 1e-3
#: A table of partitions' counts with at most this many rows (below 100 MB) is broadcast.
BROADCAST_ROWS = 1_000_000
STORED = "part int, key long, n long, tail int, nth long, full long, ids binary"
PIECES = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"


def knapsack(value: np.ndarray, lengths: np.ndarray, window: int, rng: np.random.Generator) -> np.ndarray:
    """For every room up to the window, a length that begins a dearest filling of it; 0 where nothing fits.

    ``value`` is the price of each length. Fillings within ``SPREAD`` of the dearest are drawn from.
    """
    best, pick = np.zeros(window + 1), np.zeros(window + 1, np.int64)
    price, fits = value[lengths], np.searchsorted(lengths, np.arange(window + 1), "right")
    noise = rng.random(2 * len(lengths) + 1) * SPREAD * price.max() * window / lengths[price.argmax()]
    shift = rng.integers(0, len(lengths) + 1, window + 1)
    for room in range(1, window + 1):
        best[room], pick[room], m = best[room - 1], pick[room - 1], fits[room]
        if m:
            worth = price[:m] + best[room - lengths[:m]]
            k = int((worth + noise[shift[room] : shift[room] + m]).argmax())
            if worth[k] >= best[room - 1]:
                best[room], pick[room] = worth[k], lengths[k]
    return pick


def mixtures_with(first: np.ndarray, pick: np.ndarray, window: int) -> np.ndarray:
    """For each length, a mixture that holds it: a row of lengths from the longest, filled up with zeros."""
    columns, room = [first], window - first
    while (item := pick[room]).any():
        columns.append(item)
        room = room - item
    return -np.sort(-np.stack(columns, axis=1), axis=1)


def solve(stock: np.ndarray, window: int, seed: int = 9) -> dict[tuple[int, ...], float]:
    """How many sequences of each mixture to fill, as fractions: a near-least cover of ``stock`` by multiplicative weights."""
    size, n = np.arange(window + 1), stock.astype(float)
    rng, placed, out, any_fill = np.random.default_rng(seed), np.zeros(window + 1), {}, False
    for _ in range(ROUNDS):
        open_ = np.flatnonzero((stock > 0) & (placed < 1 - 1e-9))
        if not len(open_):
            break
        price = np.zeros(window + 1)
        price[open_] = open_**POWER * np.exp(-FALL * placed[open_])
        rows = mixtures_with(open_, knapsack(price, open_, window, rng), window)
        total = rows.sum(axis=1)
        # Full sequences only, those of the longest pieces first; all by price where full ones no longer lead on.
        if not any_fill:
            rows = rows[total == total.max()]
        rows = rows[np.argsort(-(price[rows].sum(axis=1) if any_fill else rows[:, 0]), kind="stable")]
        left = np.minimum(SHARE * n, (1 - placed) * n)
        before = float(((1 - placed) * n * size).sum())
        for row in rows:
            items, times = np.unique(row[row > 0], return_counts=True)
            x = float((left[items] / times).min())
            if x > 1e-6:
                left[items] -= x * times
                placed[items] += x * times / n[items]
                mixture = tuple(row[row > 0].tolist())
                out[mixture] = out.get(mixture, 0.0) + x
        any_fill = before - float(((1 - placed) * n * size).sum()) < 0.005 * before
    return out


def rounded(shares: dict[tuple[int, ...], float], stock: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole sequences, as (mixture, how many): the shares rounded up while stock lasts, then best fit for the rest.

    All sequences of a mixture are placed at once, so the work depends on the number of lengths alone.
    """
    left = stock.copy()
    gaps: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(window + 1)]
    for mixture, x in sorted(shares.items(), key=lambda s: (-s[1], s[0])):
        items, times = np.unique(mixture, return_counts=True)
        k = int(min(np.ceil(x - 1e-9), (left[items] // times).min()))
        if k:
            left[items] -= k * times
            gaps[window - sum(mixture)].append((mixture, k))
    for length in np.flatnonzero(left)[::-1].tolist():
        n, gap = int(left[length]), length
        while n:
            # The smallest gap that takes it; an empty sequence is the last resort.
            while gap < window and not gaps[gap]:
                gap += 1
            mixture, k = gaps[gap].pop() if gap < window else ((), n)
            per = min(gap // length, n)
            filled = min(k, n // per)
            gaps[gap - per * length].append((mixture + (length,) * per, filled))
            n -= per * filled
            if mixture and k > filled:
                gaps[gap].append((mixture, k - filled))
    return [g for row in gaps for g in row]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go: ranges of their places, each with its first sequence and its offset."""

    window: int
    first: np.ndarray
    lead: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``nth`` piece of each length."""
        at = self.first[length] + nth
        k = np.searchsorted(self.lead, at, "right") - 1
        return self.sequence[k] + at - self.lead[k], self.offset[k]


def plan(stock: np.ndarray, window: int) -> Plan:
    """A plan for ``stock[length]`` pieces of each length below the window."""
    rows, sequence = [], 0
    for mixture, k in rounded(solve(stock, window), stock, window):
        offset = 0
        for length in mixture:
            rows.append((length, k, sequence, offset))
            offset += length
        sequence += k
    table = np.array(rows, np.int64).reshape(-1, 4)
    table = table[np.argsort(table[:, 0], kind="stable")]
    first = np.concatenate([[0], np.cumsum(stock)])[: window + 1]
    return Plan(window, first, np.cumsum(table[:, 1]) - table[:, 1], table[:, 2], table[:, 3], sequence)


def _ranks(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many equal values stood before each, those of earlier calls included (``seen``, which is brought up to date)."""
    order = np.argsort(values, kind="stable")
    begins = np.searchsorted(values[order], values[order])
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - begins + seen[values[order]]
    seen += np.bincount(values, minlength=len(seen))
    return out


def stored(docs: DataFrame, tokenizer: str, end_id: int, window: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's ids, the length of its last piece, and that piece's place among its partition's of that length."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen, full = np.zeros(window, np.int64), 0
        for batch in batches:
            for i, j in pieces(batch.column(1)):
                ids, n = with_end(*tool.encode(*text_bytes(batch.column(1)[i:j])), end_id)
                cuts = (np.concatenate([[0], np.cumsum(n)]) * ids.itemsize).tolist()
                raw = ids.tobytes()
                whole = n // window
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(j - i, part, np.int32)),
                        batch.column(0)[i:j].cast(pa.int64()),
                        pa.array(n),
                        pa.array((n % window).astype(np.int32)),
                        pa.array(_ranks(n % window, seen)),
                        pa.array(full + np.cumsum(whole) - whole),
                        pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    ["part", "key", "n", "tail", "nth", "full", "ids"],
                )
                full += int(whole.sum())

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(encode, STORED)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of a document: its place in its sequence and its ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        small = max(json.load(f)["model"]["vocab"].values()) < 1 << 16 and end_id < 1 << 16
    dtype = np.uint16 if small else np.uint32
    written = staged(stored(docs, tokenizer, end_id, window, doc_id, text), "encoded")
    counts = staged(written.where("tail > 0").groupBy("part", "tail").agg(F.count("*").alias("n")), "lengths")
    stock = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n")).collect():
        stock[r["tail"]] = r["n"]
    told = spark.sparkContext.broadcast(plan(stock, window))
    before = F.sum("n").over(Window.partitionBy("tail").orderBy("part")) - F.col("n")
    bases = counts.select("part", "tail", before.alias("base"))
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_ROWS else bases

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_ = told.value
        for batch in batches:
            part, keys, n, tail, nth, full = (batch.column(k) for k in range(6))
            n, tail, nth, full, part = (x.to_numpy() for x in (n, tail.cast(pa.int64()), nth, full, part.cast(pa.int64())))
            count = -(-n // window)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * window
            length = np.minimum(window, n[row] - start)
            # Full pieces are sequences of their own, numbered by partition behind those of the plan.
            sequence, offset = plan_.sequences + (part[row] << 33) + full[row] + piece, np.zeros(len(row), np.int64)
            rest = np.flatnonzero(length < window)
            sequence[rest], offset[rest] = plan_.place(tail[row[rest]], nth[row[rest]])
            cells = [np.frombuffer(x, dtype) for x in batch.column(6).to_pylist()]
            for i in range(0, len(row), 4096):
                k = slice(i, i + 4096)
                raw = [cells[r][a : a + m].astype("<u4").tobytes() for r, a, m in zip(row[k].tolist(), start[k].tolist(), length[k].tolist())]
                columns = [keys.take(pa.array(row[k])), piece[k].astype(np.int32), start[k], length[k], sequence[k], offset[k], pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                    ["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"],
                )

    placed = written.join(bases, ["part", "tail"], "left").select(
        "part", "key", "n", "tail", (F.col("nth") + F.coalesce("base", F.lit(0))).alias("nth"), "full", "ids"
    )
    return placed.mapInArrow(cut, PIECES)
