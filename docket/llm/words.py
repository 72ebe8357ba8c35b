"""Vectorised words and word hashes over Arrow text columns.

The helpers see the UTF-8 bytes of a batch as one NumPy array. Word classes are
tables over byte values, so they hold for every script: all classes used here
separate at ASCII bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docket.session import ship

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    z = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@lru_cache(None)
def _byte_values(lower: bool) -> np.ndarray:
    table = mix(np.arange(256, dtype=np.uint64), 77) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    return table


_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, BLOCK)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        tables = []
        for base in (_BASE, inverse):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


@lru_cache(None)
def class_table(kind: str) -> np.ndarray:
    """True for the bytes of a word. ``space``: all but ASCII white space;
    ``alnum``: ASCII letters and digits and every byte of a non-ASCII character."""
    table = np.ones(256, dtype=bool)
    if kind == "space":
        table[[32, 9, 10, 11, 12, 13]] = False
    elif kind == "alnum":
        table[:48] = False
        table[58:65] = False
        table[91:97] = False
        table[123:128] = False
    else:
        raise ValueError(kind)
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the rows' offsets into them. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    return whole[base : int(offsets[-1]) if len(offsets) else 0], offsets - base


def find_words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, ends and row of every maximal run of word bytes."""
    inside = class_table(kind)[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cuts = offsets[:-1]
    cuts = cuts[cuts < len(data)]
    start[cuts] = inside[cuts]
    before = cuts[cuts > 0] - 1
    end[before] = inside[before]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every byte span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = _byte_values(lower)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + BLOCK, "right")))
        last = int(ends[j - 1])
        power, inverse = _power_tables(last - first + 1)
        total = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum(values[data[first:last]] * power[: last - first], out=total[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix(out)


def shingle_hashes(words: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hashes of every ``size`` consecutive word hashes, rows not regarded."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : k + n]
    return mix(out, seed)


def row_slices(rows: np.ndarray, n: int) -> np.ndarray:
    """For sorted row numbers, the n + 1 positions where each row's entries begin."""
    return np.searchsorted(rows, np.arange(n + 1))


def pieces(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    _, offsets = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def bounded_batches(spark, megabytes: int = 8) -> None:
    """Have Spark hand Arrow batches of bounded size to Python workers, which get this package.

    The default bound is 10,000 rows; with long texts that can be gigabytes.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of ``values`` (64-bit hashes); ranges may overlap."""
    power, inverse = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64), 21)


def dealt(docs: DataFrame, blocks_per_partition: int = 8, key: str = "doc_id") -> DataFrame:
    """``docs`` in blocks by hash of their id, in a column ``__block``.

    Steps that group by the block share one shuffle of the texts. There are several blocks for
    each of the session's shuffle partitions, so a block's size follows that setting.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(n * blocks_per_partition)).cast("int")
    return docs.withColumn("__block", block).repartition(n, "__block")
