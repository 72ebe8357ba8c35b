"""The random numbers that Spark's tree learners draw, many streams at a time.

A stream of Spark's xor-shift numbers is a linear map of 64 bits applied again and again, so a stream can be begun at any
place by a table look-up, and a long one is drawn as many short ones side by side.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

_64, _32 = (1 << 64) - 1, (1 << 32) - 1


def _murmur3(data: bytes, seed: int) -> int:
    """The 32-bit hash by which Spark spreads a seed; data of whole words."""
    h = seed
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & _32
        k = (k << 15 | k >> 17) & _32
        h ^= k * 0x1B873593 & _32
        h = (h << 13 | h >> 19) & _32
        h = h * 5 + 0xE6546B64 & _32
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _32
    h = (h ^ h >> 13) * 0xC2B2AE35 & _32
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    """The state that a seed begins with."""
    data = struct.pack(">Q", seed & _64)
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


class XorShift:
    """One stream."""

    def __init__(self, seed: int):
        self.state = hashed_seed(seed)

    def bits(self, n: int) -> int:
        s = self.state
        s ^= s << 21 & _64
        s ^= s >> 35
        s ^= s << 4 & _64
        self.state = s
        return s & ((1 << n) - 1)

    def next_int(self) -> int:
        n = self.bits(32)
        return n - (1 << 32) if n >> 31 else n

    def next_double(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


class JavaRandom:
    """The plain generator of the language that Spark is written in."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next_int(self) -> int:
        self.state = self.state * 0x5DEECE66D + 0xB & ((1 << 48) - 1)
        n = self.state >> 16
        return n - (1 << 32) if n >> 31 else n

    def next_long(self) -> int:
        n = (self._next_int() << 32) + self._next_int() & _64
        return n - (1 << 64) if n >> 63 else n


def _step(s: np.ndarray) -> None:
    s ^= s << np.uint64(21)
    s ^= s >> np.uint64(35)
    s ^= s << np.uint64(4)


def _jump_table(steps: int) -> np.ndarray:
    """What each byte of a state adds to the state so many steps later."""
    image = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(steps):
        _step(image)
    table = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for value in range(1, 256):
            low = value & -value
            table[byte, value] = table[byte, value ^ low] ^ image[8 * byte + low.bit_length() - 1]
    return table


class RowDraws:
    """For rows in their order, whether each of several streams draws them: its next number lies below the rate."""

    #: Rows that one piece of a stream draws.
    PIECE = 32
    _table: np.ndarray | None = None

    def __init__(self, seeds: Sequence[int], rate: float):
        self.state = np.array([hashed_seed(s) for s in seeds], np.uint64)
        self.below = np.uint64(int(np.ceil(rate * 2.0**53)))
        if RowDraws._table is None:
            RowDraws._table = _jump_table(2 * self.PIECE)

    def _jumped(self, s: np.ndarray) -> np.ndarray:
        out = np.zeros_like(s)
        for byte in range(8):
            out ^= self._table[byte][(s >> np.uint64(8 * byte)) & np.uint64(255)]
        return out

    def take(self, rows: int) -> np.ndarray:
        """The next rows' draws, ``[row, stream]``."""
        pieces = -(-rows // self.PIECE)
        state = np.empty((pieces, len(self.state)), np.uint64)
        state[0] = self.state
        for i in range(1, pieces):
            state[i] = self._jumped(state[i - 1])
        out = np.empty((self.PIECE, *state.shape), bool)
        ends = rows - (pieces - 1) * self.PIECE
        for k in range(self.PIECE):
            _step(state)
            number = (state & np.uint64((1 << 26) - 1)) << np.uint64(27)
            _step(state)
            number += state & np.uint64((1 << 27) - 1)
            out[k] = number < self.below
            if k + 1 == ends:
                self.state = state[-1].copy()
        return out.transpose(1, 0, 2).reshape(-1, len(self.state))[:rows]
