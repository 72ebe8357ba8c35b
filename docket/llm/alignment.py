"""Align two tokenizers' tokens of the same bytes, and score the links by corpus counts.

Both tokenizers cut a text's bytes into tokens. Two tokens of different tokenizers are linked where their byte
ranges overlap; the components of these links are the groups between two places where both cut.
Groups are found by pointer jumping: every token points to its farthest-right overlapping token of the
other tokenizer, or to itself where it is the last of those that end at the same byte. Doubling the
pointers of all tokens of a block at once (``to = to[to]``) ends at each component's terminal token, which
labels the group.

A block holds a bounded number of bytes of one partition's texts. It keeps, for every document, its
distinct linked id pairs as places in the block's own list of pairs. Only these lists are
shuffled, one row for each pair and block, to count in how many documents a pair is linked and which pairs of
an id are its best; the counts come back to the block, where a document's sums are made. So a pair that every
document holds is one row for each block, and texts never move.

Defined results: texts that are null, empty or not given back byte for byte by either tokenizer have no
tokens, zeros and an empty digest; strings of special tokens in a text are plain text; a repeated row
counts as a document of its own; nulls in other columns and the names of other columns do not matter, as only the id and
the text are read; an empty table gives no rows; a text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docket.llm.encode import ChunkEncoder
from docket.llm.words import bounded_batches, pieces, text_bytes
from docket.session import staged

BLOCK_BYTES = 8 << 20
#: Texts are tokenised in pieces of this size; a worker keeps the ids of so many chunks for each tokenizer.
PIECE_BYTES, KNOWN = 1 << 20, 1_000_000
#: A pair of ids is one number: the first tokenizer's id times this, plus the second's.
PAIR = 1 << 32
SPACE = 0x20
ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, entries array<long>, places binary, times binary, pair array<long>, documents array<long>"
)


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Bytes(ChunkEncoder):
    """An encoder that knows the bytes of its tokens."""

    def _keep(self, words: list[bytes]) -> None:
        self.width = np.array([len(w) for w in words], dtype=np.int64)
        self.begin = np.cumsum(self.width) - self.width
        self.letters = np.frombuffer(b"".join(words), np.uint8)

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ids of each row, and whether the row's tokens give back its bytes."""
        if len(self.lengths) > KNOWN:
            self._clear()
        ids, counts = self.encode(data, offsets)
        ids = ids.astype(np.int64)
        size = np.diff(offsets)
        good = _sums(self.width[ids], _cuts(counts)) == size
        if not good.all():
            data, of_good = data[np.repeat(good, size)], ids[np.repeat(good, counts)]
        else:
            of_good = ids
        width = self.width[of_good]
        before = np.cumsum(width) - width
        joined = self.letters[np.repeat(self.begin[of_good] - before, width) + np.arange(len(data))]
        wrong = np.flatnonzero(joined != data)
        if len(wrong):
            good[np.flatnonzero(good)[np.searchsorted(np.cumsum(size[good]), wrong, "right")]] = False
        return ids, counts, good


class ByteTokens(_Bytes):
    """A byte-level vocabulary; strings of special tokens are encoded as text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = None
        byte, vocabulary = _byte_level(), self.tokenizer.get_vocab()
        words = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            words[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self._keep(words)


class PieceTokens(_Bytes):
    """A sentencepiece model that writes a space before the text and keeps all others."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # Texts are cut before spaces only if no piece reaches over one.
        self.whole = any("▁" in p.lstrip("▁") for p in names)
        self.space = [names.index("▁")]
        self.added, self.lower = None, False
        self.dtype = np.uint16 if len(names) <= 1 << 16 else np.uint32
        self._clear()
        self._keep([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)])

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.zeros(len(data), dtype=bool)
        if not self.whole:
            cut[1:] = (data[1:] == SPACE) & (data[:-1] != SPACE)
        cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return starts, ends, np.searchsorted(offsets, starts, "right") - 1

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        # Every chunk begins with a space, which the model writes itself, but not before nothing.
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [np.array(x if t != " " else self.space, dtype=self.dtype) for t, x in zip(texts, found)]


_tools: dict[str, _Bytes] = {}


def tokens(path: str) -> _Bytes:
    """The worker's tokenizer for a file; it and its cache live as long as the worker."""
    if path not in _tools:
        _tools[path] = PieceTokens(path) if path.endswith(".model") else ByteTokens(path)
    return _tools[path]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal of each token's component, by pointer jumping.

    Tokens are given by the bytes at which they end; both tokenizers cover the same bytes without gaps. A
    terminal is the place in ``ends_b`` of the component's last token.
    """
    n = len(ends_a)
    to = np.empty(n + len(ends_b), dtype=np.int64)
    # The token that covers the last byte of one is the farthest-right that overlaps it.
    to[:n] = n + np.searchsorted(ends_b, ends_a)
    over = np.searchsorted(ends_a, ends_b)
    to[n:] = np.where(ends_a[over] == ends_b, np.arange(n, len(to)), over) if n else np.arange(n, len(to))
    while True:
        next_ = to[to]
        if np.array_equal(next_, to):
            return to[:n] - n, to[n:] - n
        to = next_


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all overlapping tokens, as pairs."""
    begins_a = np.concatenate([[0], ends_a[:-1]])
    low = np.searchsorted(ends_b, begins_a, "right")
    count = np.searchsorted(ends_b, ends_a) - low + 1
    a = np.repeat(np.arange(len(ends_a)), count)
    return a, np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(a))


class GroupTexts:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``: decimal ids, each with the sign that follows it."""

    def __init__(self, first: _Bytes, second: _Bytes) -> None:
        self.size = max(len(first.width), len(second.width))
        self.parts = [f"{i}{sign}" for sign in (",", "|", ";", "") for i in range(self.size)]

    def rows(self, ids_a, ids_b, last_a, last_b, cuts_a, cuts_b) -> list[str]:
        """One text for each row; ``last_a`` and ``last_b`` are the terminals of the tokens."""
        a, b = np.arange(len(ids_a)), np.arange(len(ids_b))
        final_a = np.append(last_a[1:] != last_a[:-1], True)
        final_b = last_b == b
        # A group's first tokens stand before its others.
        place_a = a + np.concatenate([[0], np.flatnonzero(final_b) + 1])[np.cumsum(final_a) - final_a]
        place_b = b + (np.flatnonzero(final_a) + 1)[np.cumsum(final_b) - final_b]
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[place_a] = ids_a + self.size * final_a
        sign = np.where(final_b, 2, 0)
        sign[cuts_b[1:][cuts_b[1:] > cuts_b[:-1]] - 1] = 3
        code[place_b] = ids_b + self.size * sign
        parts, cuts = self.parts, (cuts_a + cuts_b).tolist()
        flat = code.tolist()
        return ["".join([parts[c] for c in flat[i:j]]) for i, j in zip(cuts[:-1], cuts[1:])]


def _planes(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, which compress well when most are small."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _cuts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[cuts])


def align_rows(
    column: pa.Array, first: _Bytes, second: _Bytes, texts: GroupTexts
) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The counts of each text, its groups as text, and every link as (row, first id, second id)."""
    data, offsets = text_bytes(column)
    n = len(column)
    filled = np.flatnonzero(np.diff(offsets))
    spaced = np.insert(data, offsets[filled], SPACE)
    cuts = offsets + np.searchsorted(filled, np.arange(n + 1))
    ids_a, count_a, good_a = first.read(spaced, cuts)
    ids_b, count_b, good_b = second.read(spaced, cuts)
    good = good_a & good_b
    ids_a, ids_b = (x[np.repeat(good, c)] for x, c in ((ids_a, count_a), (ids_b, count_b)))
    count_a, count_b = count_a * good, count_b * good
    cuts_a, cuts_b = _cuts(count_a), _cuts(count_b)
    ends_a, ends_b = np.cumsum(first.width[ids_a]), np.cumsum(second.width[ids_b])
    last_a, last_b = terminals(ends_a, ends_b)
    at_a, at_b = links(ends_a, ends_b)
    row = np.searchsorted(cuts_a, at_a, "right") - 1
    words = texts.rows(ids_a, ids_b, last_a, last_b, cuts_a, cuts_b) if len(ids_a) else [""] * n
    out = {
        "n_a": count_a,
        "n_b": count_b,
        "n_groups": _sums((last_b == np.arange(len(last_b))).astype(np.int64), cuts_b),
        "n_links": np.bincount(row, minlength=n).astype(np.int64),
    }
    return out, words, row.astype(np.int32), ids_a[at_a], ids_b[at_b]


def blocks(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block of documents: their own columns, and the links of each as places in the block's pairs."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokens(first), tokens(second)
        texts, base, k = GroupTexts(a, b), TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            counts = [len(h[0]) for h in held]
            shift = _cuts(np.array(counts))
            pairs, at = np.unique(np.concatenate([h[4] for h in held]), return_inverse=True)
            # The distinct pairs of every document, in its order; how often each is linked there.
            at += np.concatenate([h[3] + s for h, s in zip(held, shift)]) * max(1, len(pairs))
            entry, times = np.unique(at, return_counts=True)
            row, place = np.divmod(entry, max(1, len(pairs)))
            entries = np.bincount(row, minlength=shift[-1])
            step = np.diff(place, prepend=0)
            step[_cuts(entries)[:-1][entries > 0]] = place[_cuts(entries)[:-1][entries > 0]]
            whole = lambda values, kind: pa.array([values], pa.list_(kind))
            columns = {
                "block": pa.array([base + k]),
                "doc_id": pa.ListArray.from_arrays([0, shift[-1]], pa.concat_arrays([h[0] for h in held])),
                **{c: whole(np.concatenate([h[1][c] for h in held]), pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
                "groups_sha256": whole([x for h in held for x in h[2]], pa.string()),
                "entries": whole(entries, pa.int64()),
                "places": pa.array([_planes(step)], pa.binary()),
                "times": pa.array([_planes(times)], pa.binary()),
                "pair": whole(pairs, pa.int64()),
                "documents": whole(np.bincount(place, minlength=len(pairs)), pa.int64()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            for i, j in pieces(batch.column(1), PIECE_BYTES):
                column = batch.column(1)[i:j]
                out, words, row, id_a, id_b = align_rows(column, a, b, texts)
                digests = [sha256(w.encode()).hexdigest() if w else "" for w in words]
                held.append((batch.column(0)[i:j].cast(pa.int64()), out, digests, row, id_a * PAIR + id_b))
                size += len(text_bytes(column)[0])
                if size >= block_bytes:
                    yield block()
                    held, size, k = [], 0, k + 1
        if held:
            yield block()

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(made, BLOCKS)


def pair_counts(made: DataFrame) -> DataFrame:
    """Rows ``(pair, n, best)``: in how many documents a pair is linked, and whether no other pair of its first id has more."""
    listed = made.select(F.explode(F.arrays_zip("pair", "documents")).alias("x")).select("x.*")
    counts = listed.groupBy("pair").agg(F.sum("documents").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def _sum_up(block: pa.Table, counted: pa.Table) -> pa.Table:
    doc = {c: block.column(c)[0] for c in block.column_names}
    rows = lambda c: doc[c].values
    order = np.argsort(counted.column("place").to_numpy())
    n = counted.column("n").to_numpy()[order]
    best = counted.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    entries = rows("entries").to_numpy()
    step, times = _numbers(doc["places"].as_py()), _numbers(doc["times"].as_py())
    # A document's places are differences that begin anew with it.
    cuts = _cuts(entries)
    total = np.cumsum(step)
    before = np.concatenate([[0], total])[cuts[:-1]]
    place = total - np.repeat(before, entries)
    return pa.table(
        {
            **{c: rows(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(_sums(best[place] * times, cuts)),
            "count_sum": pa.array(_sums(n[place] * times, cuts)),
            "groups_sha256": rows("groups_sha256"),
        }
    )


def align(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document: its tokens, groups and links, and how its links stand in the whole corpus."""
    made = staged(blocks(docs, first, second, doc_id, text, block_bytes), "aligned")
    counts = staged(pair_counts(made), "pairs")
    asked = made.select(F.col("block").alias("of"), F.posexplode("pair").alias("place", "pair"))
    told = asked.join(counts, "pair").select("of", "place", "n", "best")
    own = made.drop("pair", "documents")
    return own.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_sum_up, ROW)


def groups(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, groups)``: each document's groups as text; empty without tokens."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokens(first), tokens(second)
        texts = GroupTexts(a, b)
        for batch in batches:
            for i, j in pieces(batch.column(1), PIECE_BYTES):
                words = align_rows(batch.column(1)[i:j], a, b, texts)[1]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].cast(pa.int64()), pa.array(words, pa.string())], ["doc_id", "groups"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(made, "doc_id long, groups string")
