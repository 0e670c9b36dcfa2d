"""Vectorised text primitives shared by the corpus operators.

Everything works on the raw UTF-8 bytes of an Arrow string column with numpy,
so the cost per word is a few nanoseconds and memory is bounded by the block
size, not by the partition. Null texts count as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U64 = np.uint64
MAX64 = U64(0xFFFFFFFFFFFFFFFF)

#: ASCII white space: space, \t, \n, \v, \f, \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII that is neither letter nor digit.
NON_WORD = np.ones(256, bool)
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = False
NON_WORD[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words with full avalanche."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int, base: U64 = U64(0xD6E8FEB86659FD93)) -> np.ndarray:
    p = np.full(n, base, U64)
    p[:1] = 1
    return np.cumprod(p, dtype=U64)


_POW = _powers(256)


def powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of the odd hashing base modulo 2**64."""
    global _POW
    if n > len(_POW):
        _POW = _powers(max(n, 2 * len(_POW)))
    return _POW


try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):  # another C library: it keeps what it likes
    _libc = None


def _trim() -> None:
    """Give freed memory back to the system; workers live long and share a machine's memory."""
    if _libc is not None:
        _libc.malloc_trim(0)


@dataclass
class Block:
    """Some consecutive texts: bytes, ``offsets`` (one more than texts), first row in the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about ``limit`` bytes; a longer text is a block of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield Block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a)
        a = b
    _trim()


@dataclass
class Words:
    """Word hashes of a block, byte bounds of each word, and each text's range of words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def runs(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of the maximal runs of non-separator bytes; no run crosses two texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:] = word[:-1]
    after[:-1] = word[1:]
    return np.flatnonzero(word & (~before | edge[:-1])), np.flatnonzero(word & (~after | edge[1:])) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each byte run, a polynomial in an odd base, finalised with its length."""
    out = np.empty(len(starts), U64)
    lengths = ends - starts
    total = np.cumsum(lengths)
    a = 0
    while a < len(starts):
        done = total[a] - lengths[a]
        b = max(a + 1, int(np.searchsorted(total, done + step, "right")))
        n = lengths[a:b]
        at = total[a:b] - n - done
        inside = np.arange(int(n.sum())) - np.repeat(at, n)
        letters = data[inside + np.repeat(starts[a:b], n)].astype(U64) + U64(1)
        letters *= powers(int(n.max()) + 1)[inside]
        out[a:b] = mix(np.add.reduceat(letters, at) + n.astype(U64) * _ODD)
        a = b
    return out


def words(block: Block, separator: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Split into words and hash them; A-Z count as a-z if ``lower``."""
    data = LOWER[block.data] if lower else block.data
    starts, ends = runs(data, block.offsets, separator)
    return Words(hash_runs(data, starts, ends), starts, ends, np.searchsorted(starts, block.offsets))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and whether all of them are in the same text."""
    n = len(w.hashes)
    out = np.zeros(n, U64)
    for j in range(k):
        part = w.hashes[j:] * powers(2 * k + 2)[2 * j + 1]
        out[: max(0, n - j)] += part
    room = np.repeat(w.bounds[1:], np.diff(w.bounds)) - np.arange(n) if n else np.zeros(0, np.int64)
    return mix(out), room >= k


def winnow(values: np.ndarray, valid: np.ndarray, bounds: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least value of some ``window`` consecutive ones of their text.

    Any ``window`` consecutive values have a kept position, so two texts that share
    ``window + k - 1`` words share a kept k-gram. Texts are padded apart, so the
    choice depends on the text alone.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    pad = window - 1
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.arange(n) + (text + 1) * pad
    row = np.full(n + (len(bounds) + 1) * pad + window, MAX64, U64)
    row[at] = np.where(valid, values, MAX64)
    low, have = row.copy(), 1
    while have < window:  # low[i] = min row[i : i + have]
        step = min(have, window - have)
        low[:-step] = np.minimum(low[:-step], low[step:])
        have += step
    low[low == MAX64] = 0
    high, have = low.copy(), 1
    while have < window:  # high[i] = max low[i - have + 1 : i + 1]
        step = min(have, window - have)
        high[step:] = np.maximum(high[step:], high[:-step].copy())
        have += step
    return np.flatnonzero(valid & (high[at] == values))


class HashIndex:
    """Membership of 64-bit hashes in a bounded set: a bit table first, then binary search."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys = np.unique(keys)
        self.shift = U64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.keys >> self.shift).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values`` that are members, and the place of each in ``keys``."""
        maybe = np.flatnonzero(self.table[(values >> self.shift).astype(np.int64)])
        place = np.searchsorted(self.keys, values[maybe])
        place[place == len(self.keys)] = 0
        sure = self.keys[place] == values[maybe] if len(self.keys) else np.zeros(len(maybe), bool)
        return maybe[sure], place[sure]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def ragged(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
