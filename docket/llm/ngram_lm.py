"""An n-gram language model in Elias-Fano levels.

Level 1 holds the training words by hash, with their exact counts; a word's id is its rank. Level k
holds the grams of k words as a trie: the range of a context's successors lies between two pointers of its gram in level k - 1,
and a successor is its place among the successors of the context without its first word (in level 2, its word id). Each gram has its
quantised interpolated probability and, if it may be a context, its count. Further levels hold the contexts' quantised back-off
weights. The levels are files in the shared folder that tasks
map into memory; nothing of the model is collected or broadcast but the list of files.

    p(w)      = (count + 0.5) / (tokens + 0.5 (words + 1))
    p(w | uv) = max(count(u v w) - D, 0) / count(u v) + b(u v) p(w | v)

Grams seen less than ``least`` times are left to the back-off weight b, which is the mass the kept grams leave, so every
context's probabilities sum to one but for quantisation. Grams with a part seen less than ``least`` times
cannot reach that and are not sent through the shuffle; with ``least=1`` every gram is kept. The context of a first word is the end token.

Defined results: null and empty texts are one end token; a null id belongs to the training documents;
an empty training set gives every token probability one in the base score and in the model; equal texts get equal
scores; texts are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations


from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docket.llm.elias_fano import Level, level_file, write_level
from docket.llm.words import bounded_batches, find_words, mix, pieces, span_hashes, text_bytes
from docket.session import cleared, scratch_path, staged

END = int(mix(np.array([12345], np.uint64), 7)[0] >> np.uint64(2))
DISCOUNT, LEAST = 0.75, 2
STEPS = 24  # codes for a factor of ten
SHARD_KEYS = 2_000_000
SAMPLE_TOKENS = 2_000_000
ORDER = 3  # of the registered query


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """62-bit hashes of the lower-case words of all rows, each row with its end token, and where rows begin."""
    data, offsets = text_bytes(column)
    starts, ends, rows = find_words(data, offsets, "space")
    words = (span_hashes(data, starts, ends, lower=True) >> np.uint64(2)).astype(np.int64)
    n = len(offsets) - 1
    stop = np.searchsorted(rows, np.arange(n), "right")
    return np.insert(words, stop, END), np.concatenate([[0], stop + np.arange(1, n + 1)])


def encode(log: np.ndarray) -> np.ndarray:
    """Base-ten logarithms, not positive, as one byte."""
    return np.clip(np.rint(-log * STEPS), 0, 255).astype(np.uint8)


class _Counter:
    """Counts of distinct numbers, merged when the newly gathered ones grow as many as the old."""

    def __init__(self) -> None:
        self.keys, self.counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, values: np.ndarray) -> None:
        k, n = np.unique(values, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.waiting += len(k)
        if self.waiting > max(1_000_000, len(self.keys[0])):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        k, n = _merged(self.keys, self.counts)
        self.keys, self.counts, self.waiting = [k], [n], 0
        return k, n


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of sorted keys as one run, counts of equal keys added up."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    if len(k) and len(keys) > 1:
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        new = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        k, n = k[new], np.add.reduceat(n, new)
    return k, n


def _drained(batches: Iterator[pa.RecordBatch], draw: Callable[[pa.Array], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct numbers that ``draw`` makes of a text column, and their counts: each number once for every four million."""
    counter = _Counter()
    for batch in batches:
        for i, j in pieces(batch.column(0)):
            counter.add(draw(batch.column(0)[i:j]))
            if len(counter.keys[0]) > 4_000_000:
                yield counter.merge()
                counter = _Counter()
    yield counter.merge()


def _counted(texts: DataFrame, make) -> DataFrame:
    """(key, n): counts over all tasks of the numbers that ``make()`` draws from a text column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, n in _drained(batches, make()):
            for i in range(0, len(k), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(k[i : i + (1 << 17)]), pa.array(n[i : i + (1 << 17)])], ["key", "n"])

    return texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


BLOCK = "shard int, first long, n long, steps binary, counts binary"
BLOCK_ARROW = pa.schema([("shard", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("steps", pa.binary()), ("counts", pa.binary())])
ENDS = pa.list_(pa.struct([("context", pa.int64()), ("successors", pa.int64()), ("mass", pa.float64())]))


def _block(shard: int, keys: np.ndarray, counts: np.ndarray) -> dict:
    """Sorted keys as one row: the steps between them, byte by byte, and the counts in as few bytes as they need."""
    steps = np.diff(keys, prepend=keys[:1]).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return {"shard": shard, "first": int(keys[0]), "n": len(keys), "steps": planes.tobytes(), "counts": _narrow(counts).tobytes()}


def _of_block(first: int, n: int, steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, : len(steps) // n] = np.frombuffer(steps, np.uint8).reshape(-1, n).T
    return np.cumsum(wide.view("<i8").ravel()) + first, np.frombuffer(counts, f"<u{len(counts) // n}").astype(np.int64)


def _bounds(texts: DataFrame, make, share: float, shards: int) -> np.ndarray:
    """Keys that part all grams into shards of like size, judged by those of a share of the texts.

    Only the sizes of the shards follow from it; every gram goes to one of them.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, _ in _drained(batches, make()):
            some = k[np.unique(np.linspace(0, len(k) - 1, 1000).astype(np.int64))] if len(k) else k
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), len(k) / max(1, len(some))))], ["key", "weight"])

    found = (texts if share >= 1 else texts.sample(False, share, 7)).mapInArrow(places, "key long, weight double").toArrow()
    key, weight = found.column("key").to_numpy(), found.column("weight").to_numpy()
    order = np.argsort(key)
    up = np.cumsum(weight[order])
    if not len(up):
        return np.zeros(0, np.int64)
    return np.unique(key[order][np.searchsorted(up, up[-1] * np.arange(1, shards) / shards).clip(0, len(up) - 1)])


@dataclass
class Trie:
    """Where the model's levels are: of the grams by order, and of the contexts by the order of their grams."""

    root: str
    grams: list[list[dict]]
    contexts: list[list[dict]]
    total: int
    distinct: int

    def log_one(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def levels(self) -> list[Level]:
        return [Level(self.root, f"grams{k + 1}", m) for k, m in enumerate(self.grams)]

    def context(self, k: int) -> Level:
        """The contexts of grams of k words."""
        return Level(self.root, f"contexts{k}", self.contexts[k - 2])


@dataclass
class Found:
    """Where grams of one order end, the ranks of the distinct ones in order, or -1, and which of them each is."""

    at: np.ndarray
    distinct: np.ndarray
    which: np.ndarray

    @classmethod
    def of(cls, level: Level, keys: np.ndarray, at: np.ndarray) -> "Found":
        distinct, which = np.unique(keys, return_inverse=True)
        return cls(at, level.find(distinct), which)

    def spread(self, look_up: Callable[[np.ndarray], np.ndarray], out: np.ndarray) -> np.ndarray:
        """``out`` with what ``look_up`` says of each known gram, looked up once, at the place where it ends."""
        known = self.distinct >= 0
        said = np.zeros(len(known), out.dtype)
        said[known] = look_up(self.distinct[known])
        out[self.at] = np.where(known[self.which], said[self.which], out[self.at])
        return out


def starts_of(level: Level, contexts: np.ndarray) -> np.ndarray:
    distinct, inverse = np.unique(contexts, return_inverse=True)
    return level.start(distinct)[inverse]


def _suffix(levels: list[Level], k: int, context: np.ndarray, member: np.ndarray) -> np.ndarray:
    """The rank in level k - 1 of grams of level k without their first word."""
    if k == 2:
        return member
    key = levels[k - 2].keys(context)
    width = levels[k - 2].width
    return starts_of(levels[k - 2], _suffix(levels, k - 1, key // width, key % width)) + member


def _led(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows, each row led by an end token, each word's place in its row, and where rows begin."""
    words, begins = tokens(column)
    words = np.insert(words, begins[:-1], END)
    begins = begins + np.arange(len(begins))
    return words, np.arange(len(words)) - np.repeat(begins[:-1], np.diff(begins)), begins


def _contexts(ranks: list[np.ndarray], k: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a gram of k words with a known context ends, and the context's rank in level k - 1."""
    at = np.flatnonzero(places >= k - 1)
    at = at[ranks[k - 2][at - 1] >= 0]
    return at, ranks[k - 2][at - 1]


def _keys(levels: list[Level], ranks: list[np.ndarray], found: list[Found], k: int, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a gram of k words ends whose two parts of k - 1 words are known, and its key."""
    at, context = _contexts(ranks, k, places)
    both = ranks[k - 2][at] >= 0
    at, context = at[both], context[both]
    member = ranks[k - 2][at]
    if k > 2:
        member = member - found[k - 3].spread(levels[k - 2].start, np.zeros(len(places), np.int64))[at - 1]
    return at, context * width + member


def _ranks(levels: list[Level], words: np.ndarray, places: np.ndarray) -> tuple[list[np.ndarray], list[Found]]:
    """By order, the rank of the gram that ends at each word, or -1, and the grams that were looked for."""
    ranks, found = [], []
    for k in range(1, len(levels) + 1):
        at, keys = np.arange(len(words)), words
        if k > 1:
            at, keys = _keys(levels, ranks, found, k, places, levels[k - 1].width) if levels[k - 1].manifest else (at[:0], keys[:0])
        found.append(Found.of(levels[k - 1], keys, at))
        ranks.append(found[-1].spread(lambda rank: rank, np.full(len(words), -1, np.int64)))
    return ranks, found


def _narrow(n: np.ndarray) -> np.ndarray:
    return n.astype(next(t for t in ("u1", "<u2", "<u4", "<u8") if n.max() <= np.iinfo(t).max))


def train(docs: DataFrame, least: int = LEAST, discount: float = DISCOUNT, order: int = 2) -> Trie:
    """Count and write a model of the texts of ``docs`` with grams of up to ``order`` words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    root = scratch_path(spark, "trie")
    texts = docs.select("text")
    with cleared(spark):
        words = staged(_counted(texts, lambda: lambda column: tokens(column)[0]), "words")
        distinct, total = words.agg(F.count(F.lit(1)), F.sum("n")).first()
        trie = Trie(root, [], [], total or 0, distinct)
        if not distinct:
            return trie
        if distinct >= 1 << 31:
            raise ValueError("pair keys of more than 2**31 words do not fit 62 bits")

        def counts(key: np.ndarray, table: pa.Table) -> dict[str, np.ndarray]:
            return {"count": _narrow(table.column("n").to_numpy())}

        trie.grams.append(write_level(words, root, "grams1", max(8, distinct // SHARD_KEYS), counts))
    kept, width = distinct, distinct
    for k in range(2, order + 1):
        if kept * width >= 1 << 62:
            raise ValueError(f"keys of {kept} contexts and {width} successors do not fit 62 bits")
        with cleared(spark):
            kept, width = _train_level(texts, trie, k, width, least, discount, k < order)
        if not kept:
            break
    return trie


def _train_level(texts: DataFrame, trie: Trie, k: int, width: int, least: int, discount: float, counted: bool) -> tuple[int, int]:
    """Count and write the grams of k words; returns how many were kept and a context's most successors."""

    def draw_grams():
        levels = trie.levels()

        def draw(column: pa.Array) -> np.ndarray:
            words, places, _ = _led(column)
            ranks, found = _ranks(levels, words, places)
            if k == 2 and least > 1:
                seen, inverse = np.unique(ranks[0], return_inverse=True)
                often = levels[0].values("count", np.maximum(seen, 0)) >= least
                ranks[0] = np.where(often[inverse], ranks[0], -1)
            return _keys(levels, ranks, found, k, places, width)[1]

        return draw

    shards = max(8, trie.total // SHARD_KEYS)
    bounds = _bounds(texts, draw_grams, SAMPLE_TOKENS / trie.total, shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _drained(batches, draw_grams()):
            cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
            for shard, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if i < j:
                    yield pa.RecordBatch.from_pylist([_block(shard, keys[i:j], n[i:j])], BLOCK_ARROW)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault(r["shard"], []).append(_of_block(r["first"], r["n"], r["steps"], r["counts"]))
        for shard in sorted(held):
            keys, n = _merged(*map(list, zip(*held.pop(shard))))
            keys, n = keys[n >= least], n[n >= least]
            if len(keys):
                u, successors, mass = _per_context(keys // width, n - discount)
                ends = [{"context": int(u[i]), "successors": int(successors[i]), "mass": float(mass[i])} for i in sorted({0, len(u) - 1})]
                row = _block(shard, keys, n) | {"most": int(successors.max()), "ends": ends}
                yield pa.RecordBatch.from_pylist([row], BLOCK_ARROW.append(pa.field("most", pa.int64())).append(pa.field("ends", ENDS)))

    sent = texts.mapInArrow(deal, BLOCK).repartitionById(len(bounds) + 1, F.col("shard"))
    gathered = f"{BLOCK}, most long, ends array<struct<context: long, successors: long, mass: double>>"
    blocks = staged(sent.mapInArrow(gather, gathered), f"grams{k}")
    known = blocks.select("shard", "n", "most", "ends").collect()
    if not known:
        return 0, 0
    # A context at the end of a shard may reach into others: its sums are added up here, and its first shard holds it.
    ends: dict[int, tuple[int, int, float]] = {}
    for r in sorted(known, key=lambda r: r["shard"]):
        for e in r["ends"]:
            first, successors, mass = ends.get(e["context"], (r["shard"], 0, 0.0))
            ends[e["context"]] = first, successors + e["successors"], mass + e["mass"]
    most = max(*(r["most"] for r in known), *(successors for _, successors, _ in ends.values()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = trie.levels()
        for batch in batches:
            for r in batch.to_pylist():
                shard, (key, n) = r["shard"], _of_block(r["first"], r["n"], r["steps"], r["counts"])
                u, successors, mass = _per_context(key // width, n - discount)
                for i in (0, len(u) - 1):
                    mass[i] = ends[int(u[i])][2]
                of_context = levels[k - 2].values("count", u)
                back = encode(np.log10(np.maximum(1 - mass / of_context, 1e-10)))
                own = [ends[int(u[i])][0] == shard if i in (0, len(u) - 1) else True for i in (0, len(u) - 1)]
                i, j = int(not own[0]), len(u) - int(not own[1] and len(u) > 1)
                files = []
                if i < j:
                    files.append({"level": "contexts"} | level_file(trie.root, f"contexts{k}", shard, u[i:j], {"back_off": back[i:j]}))
                which = np.repeat(np.arange(len(u)), successors)
                member = key % width
                if k == 2:
                    log = trie.log_one(levels[0].values("count", member))
                else:
                    above = levels[k - 2].keys(u)
                    wide = levels[k - 2].width
                    lower = starts_of(levels[k - 2], _suffix(levels, k - 1, above // wide, above % wide))[which] + member
                    log = levels[k - 2].values("log", lower) / -STEPS
                share = (n - discount) / of_context[which]
                out = {"log": encode(np.log10(np.minimum(share + (10 ** (-back.astype(float) / STEPS))[which] * 10**log, 1.0)))}
                out |= {"count": _narrow(n)} if counted else {}
                files.append({"level": "grams"} | level_file(trie.root, f"grams{k}", shard, key, out, width))
                yield pa.RecordBatch.from_pylist(files)

    files = blocks.mapInArrow(write, "level string, shard long, n long, base long, top long, width long").collect()
    for level, manifests in (("contexts", trie.contexts), ("grams", trie.grams)):
        mine = [{c: r[c] for c in ("shard", "n", "base", "top", "width")} for r in files if r["level"] == level]
        manifests.append(sorted(mine, key=lambda r: r["base"]))
    return sum(r["n"] for r in known), most


def _per_context(context: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rising contexts: each one, how many successors it has, and the sum of their shares."""
    new = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    return context[new], np.diff(new, append=len(context)), np.add.reduceat(share, new)


def score(docs: DataFrame, trie: Trie, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = trie.levels() or [Level(trie.root, "grams1", [])]
        above = [trie.context(k) for k in range(2, len(levels) + 1)]
        for batch in batches:
            for i, j in pieces(batch.column(1)):
                words, places, begins = _led(batch.column(1)[i:j])
                ranks, found = _ranks(levels, words, places)
                known = ranks[0] >= 0
                one = found[0].spread(
                    lambda rank: trie.log_one(levels[0].values("count", rank)), np.full(len(words), trie.log_one(np.zeros(1))[0])
                )
                log = one.copy()
                for k in range(2, len(levels) + 1):

                    def back_off(rank: np.ndarray) -> np.ndarray:
                        place = above[k - 2].find(rank)
                        back = np.zeros(len(rank))
                        back[place >= 0] = above[k - 2].values("back_off", place[place >= 0]) / -STEPS
                        return back

                    at = np.flatnonzero(places >= k - 1)
                    log[at] += found[k - 2].spread(back_off, np.zeros(len(words)))[at - 1]
                    found[k - 1].spread(lambda rank: levels[k - 1].values("log", rank) / -STEPS, log)
                own = places > 0
                rows = begins[:-1] - np.arange(len(begins) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(np.diff(begins) - 1),
                        pa.array(np.add.reduceat(known[own].astype(np.int64), rows)),
                        pa.array(np.add.reduceat(one[own], rows)),
                        pa.array(np.add.reduceat(log[own], rows)),
                    ],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text").mapInArrow(
        read, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
