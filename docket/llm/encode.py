"""Token ids of whole texts by a public tokenizer, with each distinct chunk encoded once.

Both vocabularies split a text before they merge, and neither lets a token reach
from a non-space character over the white space after it. So a text may be cut
before every white space that follows a safe non-space byte, and between a letter and
ASCII punctuation: the ids of the text are the
ids of its chunks in order. Frequent chunks are encoded once per worker; the ids
come from the tokenizers library. A text that holds the string of an added token is encoded
whole, since that string is one id wherever it stands.
"""

from __future__ import annotations

import os
import re

import numpy as np

from docket.llm.words import class_table, span_hashes

CACHE_ENTRIES = 3_000_000
ASCII_LETTER, ASCII_MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
ASCII_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True
_encoders: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """The worker's encoder for a tokenizer file; its cache lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized for t in added) and self.tokenizer.normalizer is not None:
            raise ValueError("added tokens that match normalised text are not looked for")
        # Looked ahead only, so that a match over two rows hides none.
        self.added = re.compile(b"|".join(b"(?=(%s))" % re.escape(t.content.encode()) for t in added)) if added else None
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.uint16 if self.small else np.uint32
        normalizer = self.tokenizer.normalizer
        self.lower = normalizer is not None and normalizer.normalize_str("A") == "a"
        # A token's characters stand for bytes; a word-end mark stands for none.
        vocab = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token.removesuffix("</w>")) if self.lower else len(token)
        self._clear()

    def _clear(self) -> None:
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.slots = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word = class_table("space")[data]
        safe = word & ~((data >= 0x1C) & (data <= 0x1F))
        # Last bytes of Unicode white space: keep such a place whole.
        high = data >= 0x80
        if high.any():
            lead = np.zeros(len(data), dtype=bool)
            lead[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
            lead[2:] |= ((data[:-2] == 0xE1) | (data[:-2] == 0xE2) | (data[:-2] == 0xE3)) & high[2:]
            safe &= ~lead
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = ~word[1:] & safe[:-1]
        # A letter's run ends before ASCII punctuation, the apostrophe of contractions aside.
        letter = ASCII_LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & high[1:] & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] |= ASCII_MARK[data[1:]] & letter[:-1]
        begins = offsets[:-1][offsets[1:] > offsets[:-1]]
        cut[begins] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return starts, ends, np.searchsorted(offsets, starts, "right") - 1

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, dtype=np.int64)
        for keys, slots in zip(self.keys, self.slots):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                found[hit] = slots[at[hit]]
        return found

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every chunk. Chunks that begin with white space are encoded in rows of
        64 and parted again by the bytes of their tokens; a row that does not part is redone singly."""
        encode = self.tokenizer.encode
        out: list[np.ndarray] = [None] * len(texts)
        alone, group = [], []
        for i, t in enumerate(texts):
            (group if t[0] in " \t\n\v\f\r" and not t[-1].isspace() else alone).append(i)
        for k in range(0, len(group), 64):
            part = group[k : k + 64]
            ids = np.array(encode("".join([texts[i] for i in part]), add_special_tokens=False).ids, dtype=self.dtype)
            ends = np.cumsum([len((texts[i].lstrip() if self.lower else texts[i]).encode()) for i in part])
            reached = np.cumsum(self.token_bytes[ids])
            cuts = np.searchsorted(reached, ends)
            if len(ids) and cuts[-1] == len(ids) - 1 and np.array_equal(reached[cuts], ends):
                for i, piece in zip(part, np.split(ids, cuts[:-1] + 1)):
                    out[i] = piece
            else:
                alone.extend(part)
        for i in alone:
            out[i] = np.array(encode(texts[i], add_special_tokens=False).ids, dtype=self.dtype)
        return out

    def _add(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Encode new chunks; ``hashes`` are sorted and not yet known."""
        first = len(self.lengths)
        ids = self._ids(texts)
        lengths, flat = [len(x) for x in ids], np.concatenate(ids)
        n = len(flat)
        if self.used + n > len(self.pool):
            grown = np.zeros(max(2 * len(self.pool), self.used + n), self.dtype)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + n] = flat
        lengths = np.array(lengths, dtype=np.int32)
        self.starts = np.append(self.starts, self.used + np.cumsum(lengths, dtype=np.int64) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.used += n
        self._merge(1, hashes, np.arange(first, first + len(texts), dtype=np.int32))
        if len(self.keys[1]) > 200_000 + len(self.keys[0]) // 4:
            self._merge(0, self.keys[1], self.slots[1])
            self.keys[1], self.slots[1] = self.keys[1][:0], self.slots[1][:0]

    def _merge(self, level: int, keys: np.ndarray, slots: np.ndarray) -> None:
        at = np.searchsorted(self.keys[level], keys)
        self.keys[level] = np.insert(self.keys[level], at, keys)
        self.slots[level] = np.insert(self.slots[level], at, slots)

    def _holding(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The rows that hold an added token's string."""
        found = [(m.start(), m.end(m.lastindex)) for m in self.added.finditer(memoryview(data))] if self.added and len(data) else []
        if not found:
            return np.zeros(0, np.int64)
        start, end = np.array(found).T
        row = np.searchsorted(offsets, start, "right") - 1
        return np.unique(row[end <= offsets[row + 1]])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in order, and how many each row has."""
        whole = self._holding(data, offsets)
        if not len(whole):
            return self._encode(data, offsets)
        own = [self.tokenizer.encode(data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8"), add_special_tokens=False).ids for r in whole.tolist()]
        sizes, rest = np.diff(offsets), np.ones(len(offsets) - 1, bool)
        rest[whole] = False
        ids, counts = self._encode(data[np.repeat(rest, sizes)], np.concatenate([[0], np.cumsum(sizes * rest)]))
        lengths = np.array([len(x) for x in own])
        ids = np.insert(ids, np.repeat(np.cumsum(counts)[whole], lengths), np.concatenate(own).astype(self.dtype))
        counts[whole] = lengths
        return ids, counts

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, self.dtype), np.zeros(rows, np.int64)
        if len(self.lengths) > CACHE_ENTRIES:
            self._clear()
        starts, ends, row = self._chunks(data, offsets)
        hashes = span_hashes(data, starts, ends, self.lower)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        slots = self._find(distinct)
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw = data.tobytes()
            at = first[new]
            self._add(distinct[new], [raw[s:e].decode("utf-8") for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            slots[new] = np.arange(len(self.lengths) - len(new), len(self.lengths))
        slots = slots[inverse]
        lengths = self.lengths[slots].astype(np.int64)
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = self.pool[np.repeat(self.starts[slots] - before, lengths) + np.arange(total)]
        return ids, np.bincount(row, weights=lengths, minlength=rows).astype(np.int64)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put the end id behind each row's ids."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
