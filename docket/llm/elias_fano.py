"""Elias-Fano sequences in memory-mapped files.

``n`` rising numbers below ``u`` take about ``2 + log2(u / n)`` bits each: the low bits are packed,
the high bits are a unary row in which the i-th number sets bit ``high + i``. A search for a number goes to the
bucket of its high bits, by selecting zeros in the unary row with a directory of its words, and
halves the bucket on its low bits. All searches are vectorised.

A trie's level keeps the successors of each context as a range between two pointers (``Successors``).
A level is a table of such sequences in ranges of the key, one file each, with payload arrays beside the keys.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from docket.llm.files import put
from docket.llm.words import bounded_batches

ONE = np.uint64(1)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each value, one behind the other, and a spare word."""
    parts = []
    for i in range(0, len(values), 1 << 16):
        some = values[i : i + (1 << 16)]
        parts.append(np.packbits(((some[:, None] >> np.arange(bits, dtype=np.uint64)) & ONE).astype(np.uint8).ravel(), bitorder="little"))
    raw = np.concatenate([*parts, np.zeros(16, np.uint8)])
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)]).view("<u8")


class EliasFano:
    """``arrays``: low bits, unary row, zeros and ones before each word of the unary row."""

    PARTS = ("low", "upper", "zeros", "ones")

    def __init__(self, n: int, base: int, top: int, bits: int, arrays: list[np.ndarray]) -> None:
        self.n, self.base, self.top, self.bits = n, base, top, bits
        self.low, self.upper, self.zeros, self.ones = arrays

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        """For a rising array of at least one unsigned number."""
        n, base, top = len(values), int(values[0]), int(values[-1])
        bits = max(0, ((top - base + 1) // n).bit_length() - 1)
        rest = values.astype(np.uint64) - np.uint64(base)
        low = _pack(rest & np.uint64((1 << bits) - 1), bits) if bits else np.zeros(2, "<u8")
        size = n + ((top - base) >> bits) + 1
        unary = np.zeros((size + 511) // 512 * 512, bool)
        unary[(rest >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = True
        upper = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.cumsum(np.bitwise_count(upper), dtype=np.int64)
        ones = np.append(0, ones[:-1])
        zeros = 64 * np.arange(len(upper)) - ones
        kind = "<u4" if size < 1 << 32 else "<u8"
        return cls(n, base, top, bits, [low, upper, zeros.astype(kind), ones.astype(kind)])

    def _select(self, j: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the j-th one or zero of the unary row."""
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, j.astype(before.dtype), "right") - 1
        bits = self.upper[word] ^ np.uint64(0 if ones else (1 << 64) - 1)
        left = (j - before[word].astype(np.int64)).astype(np.uint8)
        at = np.zeros(len(j), np.uint8)
        for width in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count(bits & np.uint64((1 << width) - 1))
            on = left >= below
            left -= below * on
            step = on * np.uint8(width)
            bits >>= step.astype(np.uint64)
            at += step
        return word * 64 + at

    def _next(self, place: np.ndarray, j: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the j-th one or zero, which is the first behind ``place``: mostly in the same word."""
        at = place + 1
        bits = (self.upper[at >> 6] ^ np.uint64(0 if ones else (1 << 64) - 1)) >> (at & 63).astype(np.uint64)
        out = at + np.bitwise_count((bits & -bits) - ONE)
        far = np.flatnonzero(bits == 0)
        if len(far):
            out[far] = self._select(j[far], ones)
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        high = self._select(i, True) - i
        return (high << self.bits) + self._lows(i).astype(np.int64) + self.base

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th numbers and the ones after them."""
        place = self._select(i, True)
        after = self._next(place, i + 1, True)
        low = lambda k, at: (at - k << self.bits) + self._lows(k).astype(np.int64) + self.base
        return low(i, place), low(i + 1, after)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        high = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | high) & np.uint64((1 << self.bits) - 1)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first number that is not smaller, and whether it is equal. For ``x`` in range."""
        rest = x.astype(np.uint64) - np.uint64(self.base)
        high = (rest >> np.uint64(self.bits)).astype(np.int64)
        low = rest & np.uint64((1 << self.bits) - 1)
        place = np.full(len(x), -1)
        some = high > 0
        place[some] = self._select(high[some] - 1, False)
        start, end = place + 1 - high, self._next(place, high, False) - high
        a, b = start.copy(), end.copy()
        open_ = np.flatnonzero(a < b)
        while len(open_):
            mid = (a[open_] + b[open_]) // 2
            less = self._lows(mid) < low[open_]
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]
            open_ = open_[a[open_] < b[open_]]
        equal = a < end
        equal[equal] = self._lows(a[equal]) == low[equal]
        return a, equal


class Successors:
    """Pairs of a context and a member below ``width``, in order, by their key ``context * width + member``.

    A monotone sequence of pointers has each context's range of places; the members of a range are kept relative to the
    last number of the range before, which makes all of them one rising sequence.
    """

    def __init__(self, first: int, width: int, pointers: EliasFano, members: EliasFano) -> None:
        self.first, self.width, self.pointers, self.members = first, width, pointers, members

    @classmethod
    def build(cls, keys: np.ndarray, width: int) -> "Successors":
        context, member = keys // width, keys % width
        starts = np.searchsorted(context, np.arange(context[0], context[-1] + 2))
        ends = np.append(np.flatnonzero(np.diff(context)), len(keys) - 1)
        spans = member[ends] + 1
        sizes = np.diff(ends, prepend=-1)
        values = member + np.repeat(np.cumsum(spans) - spans, sizes)
        return cls(int(context[0]), width, EliasFano.build(starts), EliasFano.build(values))

    def start(self, contexts: np.ndarray) -> np.ndarray:
        """How many pairs have a smaller context."""
        return self.pointers.access(np.clip(contexts - self.first, 0, self.pointers.n - 1))

    def _offset(self, start: np.ndarray) -> np.ndarray:
        return np.where(start > 0, self.members.access(np.maximum(start - 1, 0)) + 1, 0)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key that is there, and whether it is. ``x`` are in order and in range."""
        context, member = x // self.width, x % self.width
        new = np.append(True, context[1:] != context[:-1])
        which = np.cumsum(new) - 1
        own = context[new] - self.first
        start, end = self.pointers.access_two(own)
        target, end = self._offset(start)[which] + member, end[which]
        equal = (start[which] < end) & (target >= self.members.base) & (target <= self.members.top)
        place = np.zeros(len(x), np.int64)
        place[equal], found = self.members.successor(target[equal])
        equal[equal] = found
        return place, equal & (place < end)

    def keys(self, places: np.ndarray) -> np.ndarray:
        context = self.pointers.successor(places + 1)[0] - 1
        member = self.members.access(places) - self._offset(self.pointers.access(context))
        return (context + self.first) * self.width + member


def level_file(root: str, name: str, shard: int, key: np.ndarray, payload: dict[str, np.ndarray], width: int = 0) -> dict:
    """Write one file of a level: distinct keys in order and arrays beside them. Returns its entry."""
    if width:
        pairs = Successors.build(key, width)
        sequences = {"members": pairs.members, "pointers": pairs.pointers}
    else:
        sequences = {"keys": EliasFano.build(key)}
    arrays = {f"{name} {part}": getattr(x, part) for name, x in sequences.items() for part in EliasFano.PARTS} | payload
    kinds = {k: [a.dtype.str, len(a)] for k, a in arrays.items()}
    heads = {name: [x.n, x.base, x.top, x.bits] for name, x in sequences.items()}
    head = json.dumps({"sequences": heads, "first": int(key[0] // width) if width else 0, "arrays": kinds}).encode()
    head += b" " * (-(len(head) + 8) % 8)

    def content(out) -> None:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))

    put(root, f"{name}-{shard:06d}", content)
    return {"shard": shard, "n": len(key), "base": int(key[0]), "top": int(key[-1]), "width": width}


def write_level(rows: DataFrame, root: str, name: str, shards: int, payload: Callable[[np.ndarray, pa.Table], dict[str, np.ndarray]]) -> list[dict]:
    """Write distinct ``rows`` by their column ``key`` (not negative) to files in ranges of the key.

    ``payload`` makes a file's other arrays from its keys and rows. Returns one entry for each file.
    """
    spark = rows.sparkSession
    bounded_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [pa.Table.from_batches([b]) for b in batches]
        if not parts or not sum(p.num_rows for p in parts):
            return
        table = pa.concat_tables(parts)
        key = table.column("key").to_numpy()
        yield pa.RecordBatch.from_pylist([level_file(root, name, TaskContext.get().partitionId(), key, payload(key, table))])

    found = rows.repartitionByRange(shards, "key").sortWithinPartitions("key").mapInArrow(write, "shard long, n long, base long, top long, width long")
    return sorted((r.asDict() for r in found.collect()), key=lambda r: r["base"])


class Level:
    """A level opened for searches. On a local or mounted store its files are mapped, else read."""

    def __init__(self, root: str, name: str, manifest: list[dict]) -> None:
        self.root, self.name, self.manifest = root, name, manifest
        self.bases = np.array([m["base"] for m in manifest], np.int64)
        self.before = np.concatenate([[0], np.cumsum([m["n"] for m in manifest])]).astype(np.int64)
        self.width = manifest[0]["width"] if manifest else 0
        self.open: dict[int, tuple[EliasFano | Successors, dict[str, np.ndarray]]] = {}

    def __len__(self) -> int:
        return int(self.before[-1])

    def shard(self, k: int) -> tuple[EliasFano | Successors, dict[str, np.ndarray]]:
        if k not in self.open:
            fs, path = pafs.FileSystem.from_uri(self.root)
            path = f"{path}/{self.name}-{self.manifest[k]['shard']:06d}"
            if isinstance(fs, pafs.LocalFileSystem):
                raw = np.asarray(np.memmap(path, np.uint8, "r"))
            else:
                with fs.open_input_file(path) as f:
                    raw = np.frombuffer(f.read(), np.uint8)
            size = int.from_bytes(raw[:8].tobytes(), "little")
            head, at = json.loads(raw[8 : 8 + size].tobytes()), 8 + size
            arrays = {}
            for key, (kind, n) in head["arrays"].items():
                nbytes = np.dtype(kind).itemsize * n
                arrays[key] = raw[at : at + nbytes].view(kind)
                at += nbytes + (-nbytes % 8)
            parts = {x: EliasFano(*of, [arrays.pop(f"{x} {part}") for part in EliasFano.PARTS]) for x, of in head["sequences"].items()}
            sequence = Successors(head["first"], self.width, parts["pointers"], parts["members"]) if self.width else parts["keys"]
            self.open[k] = sequence, arrays
        return self.open[k]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rank of every key among all keys of the level, or -1. ``keys`` are in order."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.manifest):
            return out
        at = np.searchsorted(self.bases, keys, "right") - 1
        edges = np.searchsorted(at, np.arange(len(self.manifest) + 1))
        for k in range(len(self.manifest)):
            i, j = int(edges[k]), int(np.searchsorted(keys[: edges[k + 1]], self.manifest[k]["top"], "right"))
            if i < j:
                place, equal = self.shard(k)[0].successor(keys[i:j])
                out[i:j] = np.where(equal, self.before[k] + place, -1)
        return out

    def values(self, name: str, ranks: np.ndarray) -> np.ndarray:
        """A payload array of whole numbers at the given ranks, which all exist."""
        out = np.zeros(len(ranks), np.int64)  # files may keep an array in different widths
        at = np.searchsorted(self.before, ranks, "right") - 1
        for k in np.unique(at).tolist():
            mine = at == k
            out[mine] = self.shard(k)[1][name][ranks[mine] - self.before[k]]
        return out

    def start(self, contexts: np.ndarray) -> np.ndarray:
        """How many pairs of the level have a smaller context than each given one."""
        out = np.zeros(len(contexts), np.int64)
        at = np.searchsorted(self.bases // max(1, self.width), contexts, "left") - 1
        for k in np.unique(at[at >= 0]).tolist():
            mine = at == k
            out[mine] = self.before[k] + self.shard(k)[0].start(contexts[mine])
        return out

    def keys(self, ranks: np.ndarray) -> np.ndarray:
        """The pairs' keys at the given ranks, which all exist."""
        out = np.zeros(len(ranks), np.int64)
        at = np.searchsorted(self.before, ranks, "right") - 1
        for k in np.unique(at).tolist():
            mine = at == k
            out[mine] = self.shard(k)[0].keys(ranks[mine] - self.before[k])
        return out
