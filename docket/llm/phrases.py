"""Removal of repeated passages by sharded Aho-Corasick automata.

A window is ``size`` consecutive words of one document. A word goes if a window over it
also begins in a document with a smaller id; the first document keeps its words. Windows
are judged on the input.

1. Every window names an anchor: the short word run with the smallest hash inside it. Equal windows
   name equal anchors, so only windows whose anchor occurs in more than one document
   can recur. A block of documents sends each of its anchors once, with no text.
2. Blocks cut out the words around recurring anchors, each distinct piece once, and send them to
   the shard of the anchor. The shard confirms which windows recur, word by word, compiles them
   into an automaton, and streams all its pieces through it to find every occurrence.
3. Blocks get back, for each piece, the smallest document of each window, and drop the words.

A passage that a third of all documents share is one anchor row and one piece for
each block, however many documents hold it. The texts are shuffled once: all three
steps read the same exchange. Shards and blocks are bounded by the session's shuffle partitions.

Defined results: null text is empty; a document of fewer words than a window keeps
them; rows with a null id are left as they are and are nobody's source; rows with equal ids do not
judge each other; equal rows are judged alike; other columns are kept, except that
``n_words`` and ``n_removed`` are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docket.llm.words import bounded_batches, dealt, find_words, mix, range_hashes, shingle_hashes, span_hashes, text_bytes

GRAM = 5


class Windows:
    """The windows of a block's documents, in runs that share an anchor."""

    def __init__(self, table: pa.Table, size: int) -> None:
        text = table.column("text").combine_chunks()
        key = table.column("doc_id").combine_chunks().cast(pa.int64())
        self.null = key.is_null().to_numpy(zero_copy_only=False)
        self.keys = key.fill_null(0).to_numpy()
        self.data, offsets = text_bytes(text)
        self.starts, self.ends, rows = find_words(self.data, offsets, "space")
        self.row_words = np.searchsorted(rows, np.arange(len(text) + 1))
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        none = np.zeros(0, np.int64)
        self.anchors, self.row, self.first, self.count = none.astype(np.uint64), none, none, none
        grams = shingle_hashes(self.hashes, GRAM)
        n, width = len(self.hashes) - size + 1, size - GRAM + 1
        if n <= 0:
            return
        best, at = grams[:n].copy(), np.arange(n)
        for j in range(1, width):
            less = grams[j : j + n] < best
            best[less] = grams[j : j + n][less]
            at[less] = np.flatnonzero(less) + j
        whole = (rows[:n] == rows[size - 1 :]) & ~self.null[rows[:n]]
        change = np.ones(n, dtype=bool)
        change[1:] = (at[1:] != at[:-1]) | (rows[1:n] != rows[: n - 1]) | ~whole[:-1]
        first = np.flatnonzero(change & whole)
        # A run of windows ends where the anchor changes or the document does.
        stop = np.flatnonzero(change | ~whole)
        after = np.append(stop, n)[np.searchsorted(stop, first, "right")]
        self.anchors, self.row, self.first, self.count = best[first], rows[first], first, after - first

    def pieces(self, size: int) -> np.ndarray:
        """A hash of the words of each run."""
        return range_hashes(self.hashes, self.first, self.first + self.count + size - 1) ^ self.anchors


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def anchors(blocks: DataFrame, size: int) -> DataFrame:
    """(anchor, block, twice) once for each block; ``twice`` if two of its documents have it."""

    def find(table: pa.Table) -> pa.Table:
        w = Windows(table, size)
        order = np.lexsort((w.keys[w.row], w.anchors))
        a, d = w.anchors[order], w.keys[w.row][order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(a)) - 1 if len(a) else first
        block = table.column("__block")[0].as_py()
        return pa.table(
            {"anchor": _signed(a[first]), "__block": pa.array(np.full(len(first), block, np.int32)), "twice": pa.array(d[first] < d[last])}
        )

    return blocks.groupBy("__block").applyInArrow(find, "anchor long, __block int, twice boolean")


def recurring(found: DataFrame) -> DataFrame:
    """(anchor, block) of anchors that occur in two documents."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = Window.partitionBy("anchor")
    return (
        found.repartition(n, "anchor")
        .withColumn("n", F.count(F.lit(1)).over(one))
        .where("n > 1 or twice")
        .select("anchor", "__block")
    )


def cut_out(blocks: DataFrame, anchors_of: DataFrame, size: int, shards: int) -> DataFrame:
    """The distinct word runs around recurring anchors, for the anchor's shard."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["shard", "anchor", "__block", "piece", "low", "high", "words"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        w = Windows(left, size)
        wanted = np.sort(right.column("anchor").to_numpy().view(np.uint64))
        at = np.minimum(np.searchsorted(wanted, w.anchors), len(wanted) - 1)
        hit = np.flatnonzero(wanted[at] == w.anchors)
        piece = w.pieces(size)[hit]
        key = w.keys[w.row[hit]]
        order = np.lexsort((key, piece))
        piece, key, hit = piece[order], key[order], hit[order]
        first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(piece) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(piece)) - 1 if len(piece) else first
        run = hit[first]
        raw = w.data.tobytes()
        a, b = w.starts[w.first[run]], w.ends[w.first[run] + w.count[run] + size - 2]
        words = [" ".join(raw[x:y].decode("utf-8").split(" ")) for x, y in zip(a.tolist(), b.tolist())]
        anchor = w.anchors[run]
        shard = (mix(anchor, 31) % np.uint64(shards)).astype(np.int32)
        block = np.full(len(run), left.column("__block")[0].as_py(), np.int32)
        columns = [pa.array(shard), _signed(anchor), pa.array(block), _signed(piece[first]), pa.array(key[first]), pa.array(key[last])]
        return pa.table([*columns, pa.array(words, pa.string())], names)

    schema = "shard int, anchor long, __block int, piece long, low long, high long, words string"
    return blocks.groupBy("__block").cogroup(anchors_of.groupBy("__block")).applyInArrow(cut, schema)


def _spelt(lines: list[str]) -> tuple[list[str], int]:
    """Each line's words as characters of an alphabet of its own: one character a word, or two
    where there are more words than characters."""
    alphabet: dict[bytes, int] = {}
    rows = [[alphabet.setdefault(x, len(alphabet)) for x in line.encode().split()] for line in lines]
    code = lambda i: chr(i + 1 if i < 0xD000 else i + 0x1000)
    if len(alphabet) < 1_000_000:
        return ["".join(map(code, r)) for r in rows], 1
    return ["".join(code(i // 1000) + code(i % 1000) for i in r) for r in rows], 2


def locate(lines: list[str], low: np.ndarray, high: np.ndarray, size: int) -> list[tuple[list[int], list[int]]]:
    """For each piece the windows that begin in an earlier document than its last: places and
    smallest documents. ``low`` and ``high`` are a piece's smallest and largest document."""
    # Equal pieces of several blocks are searched once.
    place: dict[str, int] = {}
    which = np.array([place.setdefault(x, len(place)) for x in lines], np.int64)
    least, most = np.full(len(place), np.iinfo(np.int64).max), np.full(len(place), np.iinfo(np.int64).min)
    np.minimum.at(least, which, low)
    np.maximum.at(most, which, high)
    texts, width = _spelt(list(place))
    span = size * width
    # Confirm: the smallest document of every window, and whether it recurs at all.
    smallest: dict[str, int] = {}
    again: set[str] = set()
    for text, lo, hi in zip(texts, least.tolist(), most.tolist()):
        for i in range(0, len(text) - span + 1, width):
            window = text[i : i + span]
            known = smallest.get(window)
            if known is None:
                smallest[window] = lo
                if lo < hi:
                    again.add(window)
            else:
                again.add(window)
                if lo < known:
                    smallest[window] = lo
    automaton = ahocorasick.Automaton()
    for window in again:
        automaton.add_word(window, smallest[window])
    if not again:
        return [([], [])] * len(texts)
    automaton.make_automaton()
    found = [[((end + 1) // width - size, lo) for end, lo in automaton.iter(text) if (end + 1) % width == 0] for text in texts]
    out = []
    for k, hi in zip(which.tolist(), high.tolist()):
        early = [x for x in found[k] if x[1] < hi]
        out.append(([x[0] for x in early], [x[1] for x in early]))
    return out


def confirmed(cut: DataFrame, size: int, rows_at_once: int = 256) -> DataFrame:
    """For each piece, the windows that also begin in a smaller document.

    A shard compiles an automaton for every ``rows_at_once`` pieces or so: the library looks through
    a node's children one by one, so the root must not have a child for every word of the shard.
    """

    def search(table: pa.Table) -> pa.Table:
        anchor = table.column("anchor").to_numpy()
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        low, high = table.column("low").to_numpy()[order], table.column("high").to_numpy()[order]
        block, piece = table.column("__block").to_numpy()[order], table.column("piece").to_numpy()[order]
        words = table.column("words").combine_chunks().take(pa.array(order))
        edges = np.append(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])), len(anchor))
        rows, ats, mins, i = [], [], [], 0
        while i < len(anchor):
            # An automaton for as many whole anchors as fit.
            j = int(edges[max(np.searchsorted(edges, i, "right"), np.searchsorted(edges, i + rows_at_once, "right") - 1)])
            for r, (at, lo) in enumerate(locate(words[i:j].to_pylist(), low[i:j], high[i:j], size), i):
                if at:
                    rows.append(r)
                    ats.append(at)
                    mins.append(lo)
            i = j
        return pa.table(
            {"__block": pa.array(block[rows]) if rows else pa.array([], pa.int32()), "piece": pa.array(piece[rows]) if rows else pa.array([], pa.int64()),
             "at": pa.array(ats, pa.list_(pa.int32())), "low": pa.array(mins, pa.list_(pa.int64()))}
        )

    return cut.groupBy("shard").applyInArrow(search, "__block int, piece long, at array<int>, low array<long>")


def remove_repeats(docs: DataFrame, size: int = 13, tidy: bool = True) -> DataFrame:
    """``docs`` without repeated words: the columns of ``docs`` with ``text`` as the kept words joined
    by one space, and ``n_words``, ``n_removed``. Unless ``tidy``, texts that lose no word stay as they are."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    blocks = dealt(docs.select(*columns))
    found = confirmed(cut_out(blocks, recurring(anchors(blocks, size)), size, shards), size)

    def drop(left: pa.Table, right: pa.Table) -> pa.Table:
        w = Windows(left, size)
        gone = np.zeros(len(w.starts) + 1, dtype=np.int64)
        if right.num_rows and len(w.first):
            piece = right.column("piece").to_numpy().view(np.uint64)
            order = np.argsort(piece)
            piece = piece[order]
            at, low = right.column("at").combine_chunks(), right.column("low").combine_chunks()
            edges, flat_at, flat_low = at.offsets.to_numpy(), at.values.to_numpy(), low.values.to_numpy()
            mine = w.pieces(size)
            where = np.minimum(np.searchsorted(piece, mine), len(piece) - 1)
            hit = np.flatnonzero(piece[where] == mine)
            row = order[where[hit]]
            count = edges[row + 1] - edges[row]
            source = np.repeat(edges[row] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            run = np.repeat(hit, count)
            later = flat_low[source] < w.keys[w.row[run]]
            start = w.first[run[later]] + flat_at[source[later]]
            np.add.at(gone, start, 1)
            np.add.at(gone, start + size, -1)
        covered = np.cumsum(gone)[:-1] > 0
        raw, texts, removed = w.data.tobytes(), [], []
        written = left.column("text").combine_chunks()
        _, offsets = text_bytes(written)
        absent = written.is_null().to_numpy(zero_copy_only=False)
        for i in range(left.num_rows):
            a, b = int(w.row_words[i]), int(w.row_words[i + 1])
            mask = covered[a:b]
            n = int(mask.sum())
            removed.append(n)
            if n:
                kept = a + np.flatnonzero(~mask)
                texts.append(b" ".join([raw[x:y] for x, y in zip(w.starts[kept].tolist(), w.ends[kept].tolist())]))
            else:
                whole = raw[offsets[i] : offsets[i + 1]]
                texts.append(b" ".join(whole.split()) if tidy else None if absent[i] else whole)
        out = left.select(columns)
        out = out.set_column(columns.index("text"), "text", pa.array(texts, pa.binary()).cast(pa.string()))
        out = out.append_column("n_words", pa.array(np.diff(w.row_words)))
        return out.append_column("n_removed", pa.array(removed, pa.int64()))

    schema = docs.select(*columns).schema.add("n_words", "long").add("n_removed", "long")
    return blocks.groupBy("__block").cogroup(found.groupBy("__block")).applyInArrow(drop, schema)
