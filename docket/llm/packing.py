"""Pack documents into fixed sequences: concatenate and cut.

Two passes over partition totals give every document its place in one endless
stream of ids; the stream is cut into windows. The first pass encodes each partition
where it lies and writes ids with the running start inside the partition. The totals,
one number for each partition, are summed up to bases. The second pass adds the base
and cuts at multiples of the window. No row moves between tasks.

Defined results: a null or empty text is its end id alone; nulls in any column are kept as
they are; equal rows are packed as often as they occur; an empty table gives no pieces;
a text of any length is cut into as many pieces as it needs. All sequences but the last
are full. The order of documents is that of the input's partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docket.llm.encode import encoder, with_end
from docket.llm.words import bounded_batches, pieces, text_bytes
from docket.session import staged

ENCODED = "part int, row long, key long, local_start long, n long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _rows(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    cuts = np.concatenate([[0], np.cumsum(counts)])
    raw, width = ids.tobytes(), ids.itemsize
    return [raw[a * width : b * width] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def encoded(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's ids and its start within its partition (first pass)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, row, at = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for i, j in pieces(batch.column(1)):
                ids, counts = with_end(*tool.encode(*text_bytes(batch.column(1)[i:j])), end_id)
                starts = at + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(j - i, part, np.int32)),
                        pa.array(np.arange(row, row + j - i)),
                        batch.column(0)[i:j].cast(pa.int64()),
                        pa.array(starts),
                        pa.array(counts),
                        pa.array(_rows(ids, counts), pa.binary()),
                    ],
                    ["part", "row", "key", "local_start", "n", "ids"],
                )
                row, at = row + j - i, at + int(counts.sum())

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(encode, ENCODED)


def bases(written: DataFrame) -> DataFrame:
    """The global start of every partition: prefix sums over the partitions' totals.

    One row for each partition of the input reaches the driver, whatever the rows.
    """
    totals = sorted(tuple(r) for r in written.groupBy("part").agg(F.sum("n")).collect())
    at, rows = 0, []
    for part, n in totals:
        rows.append((part, at))
        at += n
    return written.sparkSession.createDataFrame(rows, "part int, base long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048) -> DataFrame:
    """One row for each piece of a document: its place in its sequence and its ids
    (little-endian unsigned 32-bit)."""
    import json

    with open(tokenizer, encoding="utf-8") as f:
        small = max(json.load(f)["model"]["vocab"].values()) < 1 << 16 and end_id < 1 << 16
    dtype = np.uint16 if small else np.uint32
    written = staged(encoded(docs, tokenizer, end_id), "encoded")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, ids, start = batch.column(0), batch.column(1).to_numpy(), batch.column(2), batch.column(3).to_numpy()
            first, last = start // window, (start + n - 1) // window
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            seq = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            low = np.maximum(seq * window, start[row])
            high = np.minimum((seq + 1) * window, (start + n)[row])
            cells = [np.frombuffer(x, dtype) for x in ids.to_pylist()]
            for i in range(0, len(row), 4096):
                k = slice(i, i + 4096)
                at = low[k] - start[row[k]]
                to = high[k] - start[row[k]]
                raw = [cells[r][a:b].astype("<u4").tobytes() for r, a, b in zip(row[k].tolist(), at.tolist(), to.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(row[k])),
                        pa.array(at),
                        pa.array(to - at),
                        pa.array(n[row[k]]),
                        pa.array(seq[k]),
                        pa.array(low[k] - seq[k] * window),
                        pa.array(raw, pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    placed = written.join(F.broadcast(bases(written)), "part").select(
        "key", "n", "ids", (F.col("base") + F.col("local_start")).alias("start")
    )
    return placed.mapInArrow(cut, PIECES)


def sequences(packed: DataFrame, pad_id: int, window: int = 2048) -> DataFrame:
    """One row for each sequence: its ids padded to the window, unless their number is a
    power of two, and how many are padding. A group holds at most one window of ids."""
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))), lambda p: p["h"]), ""
    )
    n = F.sum("length")
    power = F.pow(F.lit(2.0), F.ceil(F.log2(n))).cast("long")
    pad = F.when(power == n, 0).otherwise(F.lit(window) - n)
    word = "".join(f"{b:02X}" for b in int(pad_id).to_bytes(4, "little"))
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.concat(joined, F.expr(f"repeat('{word}', cast({window} as int))").substr(F.lit(1), (pad * 8).cast("int")))).alias("ids"),
        pad.cast("long").alias("padding"),
    )
