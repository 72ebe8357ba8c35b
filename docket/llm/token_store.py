"""Token ids on disk: raw payload shards with a minimal perfect hash index.

A shard is two files. ``<n>.ids`` holds the ids of its documents one after the other,
as unsigned 16- or 32-bit little-endian numbers. ``<n>.mph`` maps a document's key to its
place: a minimal perfect hash gives a slot, the slot holds a stored fingerprint (a key
that is not there is told from one that is, but for one in 2**32), the number of the
key's first document, and how many follow under the same key. A document's number gives
its offset in the payload. A lookup reads a few words, whatever the size of the shard.

Documents are dealt to shards by ranges of the key and sorted within; shard ``n`` ends
where ``n + 1`` begins. A file is written under a name of its own and moved to its place,
so a task may run twice.

Defined results: null text is empty and has the end id alone; null keys come first and
share one entry; documents with equal keys lie next to each other, ordered by their text,
and a lookup returns all of them; an empty table has no shard and no rows; columns other
than key and text are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from docket.llm.encode import encoder, with_end
from docket.llm.files import put
from docket.llm.words import bounded_batches, mix, pieces, text_bytes
from docket.session import scratch_path

MAGIC = b"TOKIDX01"
NULL_KEY = np.uint64(0x5DEECE66D1234567)
MANIFEST = "shard int, n_docs long, n_ids long, width int, low long, high long, has_null boolean"


def _hashed(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    h = mix(keys.astype(np.uint64), 3)
    h[null] = NULL_KEY
    return h


class PerfectHash:
    """Levels of bit arrays: a key sits at the first level where no other key meets it."""

    def __init__(self, words: list[np.ndarray]) -> None:
        self.words = words
        self.ranks, before = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())

    @staticmethod
    def _places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
        return mix(hashes, level + 11) % np.uint64(bits)

    @classmethod
    def build(cls, hashes: np.ndarray) -> "PerfectHash":
        """For distinct hashes. About a third of the keys go on at each level."""
        words, left, level = [], hashes, 0
        while len(left):
            bits = max(64, (2 * len(left) + 63) // 64 * 64)
            at = cls._places(left, level, bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            left = left[~alone[at]]
            level += 1
        return cls(words)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of every hash, -1 if it certainly is no key."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        todo = np.arange(len(hashes))
        for level, (words, ranks) in enumerate(zip(self.words, self.ranks)):
            at = self._places(hashes[todo], level, 64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (ranks[word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        return out


def _index(keys: np.ndarray, null: np.ndarray, counts: np.ndarray) -> bytes:
    """The index of a shard whose documents have these keys, in order."""
    hashes = _hashed(keys, null)
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    distinct = hashes[first]
    table = PerfectHash.build(distinct)
    slot = table.slots(distinct)
    order = np.argsort(slot)
    many = np.diff(np.append(first, len(hashes)))
    arrays = [*table.words, (mix(distinct, 5)[order] >> np.uint64(32)).astype("<u4"), first[order].astype("<i8"), many[order].astype("<i8")]
    arrays.append(np.concatenate([[0], np.cumsum(counts)]).astype("<i8"))
    head = json.dumps({"levels": [len(w) for w in table.words], "keys": len(distinct), "docs": len(keys)}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in arrays)


class Shard:
    """An open shard."""

    def __init__(self, root: str, shard: int, width: int) -> None:
        self.fs, path = pafs.FileSystem.from_uri(root)
        self.payload, self.width = f"{path}/{shard:06d}.ids", width
        with self.fs.open_input_file(f"{path}/{shard:06d}.mph") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"no index: {path}/{shard:06d}.mph")
        size = int.from_bytes(raw[8:12], "little")
        head, at = json.loads(raw[12 : 12 + size]), 12 + size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.hash = PerfectHash([take("<u8", n).astype(np.uint64) for n in head["levels"]])
        self.prints, self.first, self.many = take("<u4", head["keys"]), take("<i8", head["keys"]), take("<i8", head["keys"])
        self.offsets = take("<i8", head["docs"] + 1)

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the number of its first document and how many it has; 0 if it has none."""
        hashes = _hashed(keys, null)
        slot = self.hash.slots(hashes)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == (mix(hashes[known], 5) >> np.uint64(32)).astype(np.uint32)
        slot = np.where(known, slot, 0)
        if not len(self.first):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        return np.where(known, self.first[slot], 0), np.where(known, self.many[slot], 0)

    def read(self, first: int, last: int) -> np.ndarray:
        """The ids of documents ``first`` to ``last - 1``."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        with self.fs.open_input_file(self.payload) as f:
            return np.frombuffer(f.read_at((b - a) * self.width, a * self.width), f"<u{self.width}")


def write_store(docs: DataFrame, tokenizer: str, end_id: int, shards: int | None = None) -> tuple[str, list]:
    """Encode ``docs`` (doc_id, text) into a store; returns its folder and its manifest.

    The manifest has one row for each shard: this much reaches the driver.
    """
    spark = docs.sparkSession
    root = scratch_path(spark, "ids")
    root = root if "://" in root or root.startswith("/") else root.replace("file:", "", 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if tool.small and end_id < 1 << 16 else 4
        keys, nulls, counts = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]

        def content(out) -> None:
            for batch in batches:
                for i, j in pieces(batch.column(1)):
                    ids, n = with_end(*tool.encode(*text_bytes(batch.column(1)[i:j])), end_id)
                    out.write(ids.astype(f"<u{width}").tobytes())
                    key = batch.column(0)[i:j].cast(pa.int64())
                    nulls.append(key.is_null().to_numpy(zero_copy_only=False))
                    keys.append(key.fill_null(0).to_numpy())
                    counts.append(n)

        # The name is told from the shard alone: a second run of the task writes the same.
        put(root, f"{shard:06d}.ids", content)
        key, null, n = np.concatenate(keys), np.concatenate(nulls), np.concatenate(counts)
        if len(key):
            put(root, f"{shard:06d}.mph", lambda out: out.write(_index(key, null, n)))
            real = key[~null]
            row = (shard, len(key), int(n.sum()), width, int(real.min()) if len(real) else None, int(real.max()) if len(real) else None, bool(null.any()))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    bounded_batches(spark)
    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    manifest = rows.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(write, MANIFEST).collect()
    manifest = sorted(manifest, key=lambda r: r["shard"])
    fs, path = pafs.FileSystem.from_uri(root)
    fs.create_dir(path, recursive=True)
    put(root, "manifest.json", lambda out: out.write(json.dumps([r.asDict() for r in manifest]).encode()))
    return root, manifest


def read_ids(spark: SparkSession, root: str, manifest: list, keys: DataFrame) -> DataFrame:
    """The documents stored under each distinct key: (doc_id, start, n_tokens, ids).

    ``start`` counts the ids of all documents before it; ``ids`` are unsigned 32-bit
    little-endian. Keys go to their shard by the manifest's ranges, one hash lookup finds each.
    """
    lows = np.array([r["low"] if r["low"] is not None else np.iinfo(np.int64).min for r in manifest], np.int64)
    before = np.concatenate([[0], np.cumsum([r["n_ids"] for r in manifest])]).astype(np.int64)
    number = np.array([r["shard"] for r in manifest], np.int64)
    width = manifest[0]["width"] if manifest else 4

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).cast(pa.int64())
            at = np.maximum(np.searchsorted(lows, key.fill_null(np.iinfo(np.int64).min).to_numpy(), "right") - 1, 0)
            at[key.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([key, pa.array(at.astype(np.int32))], ["doc_id", "at"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_at, shard = -1, None
        for batch in batches:
            ats = batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ats)) + 1, [len(ats)]])
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if ats[i] != open_at:
                    open_at = int(ats[i])
                    shard = Shard(root, int(number[open_at]), width)
                keys = batch.column(0)[i:j]
                first, many = shard.find(keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False))
                rows = np.repeat(np.arange(j - i), many)
                docs = np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                # Neighbouring documents are read together, a bounded number of ids at a time.
                k = 0
                while k < len(docs):
                    end = k + 1
                    while end < len(docs) and docs[end] == docs[end - 1] + 1 and shard.offsets[docs[end] + 1] - shard.offsets[docs[k]] <= 1 << 20:
                        end += 1
                    ids = shard.read(int(docs[k]), int(docs[end - 1]) + 1).astype("<u4").tobytes()
                    a = 4 * (shard.offsets[docs[k:end]] - shard.offsets[docs[k]])
                    b = 4 * (shard.offsets[docs[k:end] + 1] - shard.offsets[docs[k]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.take(pa.array(rows[k:end])),
                            pa.array(before[open_at] + shard.offsets[docs[k:end]]),
                            pa.array((b - a) // 4),
                            pa.array([ids[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    k = end

    if not manifest:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    routed = keys.select("doc_id").distinct().mapInArrow(route, "doc_id long, at int")
    return (
        routed.repartition(len(manifest), "at").sortWithinPartitions("at", "doc_id").mapInArrow(look_up, "doc_id long, start long, n_tokens long, ids binary")
    )
