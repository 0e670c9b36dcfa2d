"""Fast, exact byte-level BPE over whole texts.

A byte-level BPE tokenizer first splits a text into pre-tokens that never join a
non-space run with what follows it. So the ids of a text are those of its
segments (one optional space and a non-space run, or white space) one after the
other, and a segment's ids are the same everywhere. Segments are hashed and
looked up with numpy; only new ones go to the ``tokenizers`` library, those that a
space opens many in a row: the ids that begin with a space tell where each begins.
Texts with white space outside ASCII go to the library whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from foliant.llm._arrow import SPACE, Block, hash_runs

#: Segments that a worker remembers at most; beyond that it starts anew.
CACHE_SEGMENTS = 800_000
#: New segments that go to the library in a row.
TOGETHER = 4000
#: The commonest segments are found in a direct-mapped table of so many bits; clashes go to a binary search.
SLOT_BITS = 20
#: End-of-document id that the packing contract appends.
END_ID = 1

_SPACE_PIECE = "Ġ"
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """``ids(block)``: all ids of a block's texts in a row, and each text's range."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for piece, i in vocabulary.items() if piece[0] == _SPACE_PIECE]] = True
        self.forget()

    def forget(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.slot_key, self.slot_at = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int64)
        self.first, self.count, self.store, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _odd(self, block: Block) -> np.ndarray:
        """Texts with white space outside ASCII (or what looks like it): they are encoded whole."""
        d = block.data
        p = np.flatnonzero(_LEAD[d[:-1]]) if len(d) > 1 else np.zeros(0, np.int64)
        x, y = d[p], d[p + 1]
        hit = ((x == 0xC2) & ((y == 0x85) | (y == 0xA0))) | ((x == 0xE1) & (y == 0x9A)) | ((x == 0xE2) & ((y == 0x80) | (y == 0x81))) | ((x == 0xE3) & (y == 0x80))
        odd = np.zeros(len(block), bool)
        odd[np.searchsorted(block.offsets, p[hit], "right") - 1] = True
        return odd

    def _segments(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the segments: cuts at each change between space and non-space, but for the space that opens a word."""
        d, n = block.data, len(block.data)
        space = SPACE[d]
        cut = np.zeros(n + 1, bool)
        cut[block.offsets] = True
        opens = np.flatnonzero(~space[1:] & space[:-1] & ~cut[1:-1]) + 1  # a non-space after a space
        cut[1:-1] |= ~space[:-1] & space[1:]
        cut[opens - 1] = True  # the last of the white space stands alone or opens the word
        cut[opens[d[opens - 1] != 32]] = True
        starts = np.flatnonzero(cut[:-1])
        return starts, np.append(starts[1:], n)

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        after = np.minimum(starts + 1, len(data) - 1)
        opened = (data[starts] == 32) & (ends > starts + 1) & ~SPACE[data[after]]  # a space and a word
        order = np.concatenate([np.flatnonzero(opened), np.flatnonzero(~opened)])
        hashes, starts, ends = hashes[order], starts[order], ends[order]
        n, raw = int(opened.sum()), data.tobytes()
        size = (ends - starts)[:n]
        to = np.cumsum(size)
        row = data[np.arange(int(size.sum())) + np.repeat(starts[:n] - to + size, size)].tobytes()
        to = np.append(0, to)[[*range(0, n, TOGETHER), n]].tolist()
        apart = lambda i, j: self._encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)])
        got, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i, ids in zip(range(0, n, TOGETHER), self._encode([row[a:b].decode("utf-8", "replace") for a, b in zip(to[:-1], to[1:], strict=True)]), strict=True):
            ids = np.array(ids, np.uint32)
            opens = np.flatnonzero(self.opens[ids])
            if len(opens) == min(TOGETHER, n - i):
                got.append(ids)
                counts.append(np.diff(np.append(opens, len(ids))))
            else:  # some segment's ids don't begin where it does: white space outside ASCII, or another kind of vocabulary
                each = apart(i, min(i + TOGETHER, n))
                got += [np.array(ids, np.uint32) for ids in each]
                counts.append(np.array([len(ids) for ids in each]))
        each = apart(n, len(starts))
        got += [np.array(ids, np.uint32) for ids in each]
        counts.append(np.array([len(ids) for ids in each], np.int64))
        flat, count = np.concatenate(got), np.concatenate(counts)
        back = np.argsort(hashes)  # the caller's order, by hash
        hashes = hashes[back]
        first = (self.used + np.cumsum(count) - count)[back]
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + len(flat)] = flat
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.at = np.insert(self.keys, place, hashes), np.insert(self.at, place, np.arange(len(hashes)) + len(self.first))
        self.first, self.count = np.append(self.first, first), np.append(self.count, count[back])
        self.used += len(flat)

    def _lookup(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The place in ``first``/``count`` of each segment, and the segments' starts."""
        starts, ends = self._segments(block)
        if len(self.keys) > CACHE_SEGMENTS:
            self.forget()
        hashes = hash_runs(block.data, starts, ends)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out, rest = self.slot_at[slot], np.flatnonzero(self.slot_key[slot] != hashes)
        keys, where, back = np.unique(hashes[rest], return_index=True, return_inverse=True)
        where = rest[where]
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            self._learn(block.data, keys[new], starts[where[new]], ends[where[new]])
            place = np.searchsorted(self.keys, keys)
        out[rest] = self.at[place][back]
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        free = self.slot_key[slot] == 0
        self.slot_key[slot[free]], self.slot_at[slot[free]] = keys[free], self.at[place[free]]
        return out, starts

    def lengths(self, block: Block) -> np.ndarray:
        """Ids of each text, counted only."""
        if not len(block.data):
            return np.zeros(len(block), np.int64)
        at, starts = self._lookup(block)
        total = np.append(0, np.cumsum(self.count[at]))
        bounds = np.searchsorted(starts, block.offsets)
        out = total[bounds[1:]] - total[bounds[:-1]]
        for i in np.flatnonzero(self._odd(block)):
            out[i] = len(self._encode([block.text(i)])[0])
        return out

    def ids(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), and offsets of each text's ids."""
        if not len(block.data):
            return np.zeros(0, np.uint32), np.zeros(len(block) + 1, np.int64)
        at, starts = self._lookup(block)
        count = self.count[at]
        total = np.append(0, np.cumsum(count))
        flat = self.store[np.repeat(self.first[at] - total[:-1], count) + np.arange(total[-1])]
        bounds = total[np.searchsorted(starts, block.offsets)]
        odd = np.flatnonzero(self._odd(block))
        if not len(odd):
            return flat, bounds
        parts = [flat[bounds[i] : bounds[i + 1]] for i in range(len(block))]
        for i in odd:
            parts[i] = np.array(self._encode([block.text(i)])[0], np.uint32)
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def pieces_of(block: Block, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` after each text, and the offsets."""
    flat, bounds = encoder(path).ids(block)
    if end_id is None:
        return flat, bounds
    return np.insert(flat, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))


def ids_array(flat: np.ndarray) -> pa.Array:
    return pa.array(flat.astype(np.int32))
