"""Operator 10: language-model scoring by subword lattice likelihood.

The pieces of an existing subword vocabulary, weighted by probabilities, make a
lattice over each word; a forward recursion sums all segmentations, so
a word's probability is its marginal. The recursion multiplies probabilities that are scaled by
a constant per byte, and goes over to logarithms where a sum leaves ``TRUSTED`` and for words of over 64
bytes; the two give the same numbers (a test holds them together). The vocabulary is given and stays as it is; its
scores (ranks) are the start for the pieces' probabilities, which expectation-maximisation
fits to the distinct words of the training documents.

Every word goes through the lattice. A training word has one more arc that spans it whole.
Its weight is what the word's count is worth by absolute discounting, fitted by leaving one
out (the numbers of words seen once and twice); what that frees weighs the pieces.
A text is written in one of a few latent classes (languages, as it turns out), each with
lattice weights of its own: the whole words and the pieces of its training documents. Its whole
words are interpolated with those of all classes in the same way. A document's score is the
marginal over classes and segmentations. In every class the probabilities of all words and
the end sum to at most one.

1. The classes are found by a mixture model of hashed words, fitted to all training documents:
   their words' buckets are counted once, and each round is one pass over these counts; what comes
   back to the driver is one number per try, class and bucket. Each training document then belongs
   to its likeliest class.
2. Words are counted by class per block, then by hash over all documents: one row per
   distinct word with its training counts (0 if only held-out documents have it).
3. Each round of expectation-maximisation is one pass over that table; what comes
   back to the driver is one number per piece, in the last round one per piece and class.
4. Every distinct word gets its score in every class once. The commonest words (``HOT``, a
   fixed bound) are a small table in the shared folder, which the tasks that read the documents load;
   the others are joined by hash. Both give the same numbers.

The plain unigram model of whole words (add 0.1) is the base that the score is
compared with.

Defined cases: null and empty texts are the end alone; words without any training
count are unknown but have a lattice score by bytes; without training documents all
pieces keep their start weights, all weight is theirs, there is one class, and the base has N = 0,
V = 0; repeated rows are scored (and counted) each; a null id is never held out; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import LOWER, MAX64, U64, HashIndex, blocks, powers, ragged, signed, words
from foliant.llm.shared import cut, discard, learns, small_batches

HOT = 1 << 18
#: Classes of word counts for each doubling.
CLASSES = 16
ROUNDS = 2
#: Latent classes that are tried, the share that one needs to stay, and buckets of their words.
LATENT, LEAST_SHARE, BUCKETS = 8, 0.01, 1024
#: Fits of the classes that are tried side by side, rounds of each, and the words of a document that one may start from.
TRIES, PASSES, START_WORDS = 4, 15, 50
#: The row that counts the ends: no word is empty.
END_HASH = 0
COUNT_BLOCK = 6 << 20
#: Words of blocks are merged before they leave a task as soon as so many are held.
MERGED = 200_000
#: Rows of merged words in an Arrow batch: the engine holds each batch whole outside its heap.
WORD_ROWS = 10_000
#: Words up to this many bytes go through the lattice many at a time.
TOGETHER = 64
#: What a byte is worth (log) in the recursion without logarithms, and the range of sums that it is trusted in.
BYTE_WORTH, TRUSTED = 3.0, 1e200
_MARK = 0x20  # opens a word: no word contains a space
_SPIECE = "▁"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """Pieces (bytes; a leading space opens a word) with log probabilities, and that of the end."""

    def __init__(self, pieces: list[bytes], start: np.ndarray):
        self.pieces = pieces
        self.log_p, self.log_end = start, float(start.min())
        self.place = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        raw = np.zeros((len(pieces), self.longest), np.uint8)
        for i, p in enumerate(pieces):
            raw[i, : len(p)] = np.frombuffer(p, np.uint8)
        size = np.array([len(p) for p in pieces])
        prefix = self._prefixes(raw)
        keys = self._key(prefix[np.arange(len(pieces)), size], size)
        self.index = HashIndex(keys, 22)
        self.of_key = np.argsort(keys)
        self.size = size
        self._grow()

    def _grow(self) -> None:
        """The pieces as a trie: nodes of single bytes, an open hash table of (node, byte) with the child, and each node's piece or -1."""
        nodes: dict[bytes, int] = {}
        for p in self.pieces:
            for j in range(1, len(p) + 1):
                nodes.setdefault(p[:j], len(nodes))
        self.root, self.piece_at = np.full(256, -1, np.int32), np.full(len(nodes), -1, np.int32)
        self.piece_at[[nodes[p] for p in self.pieces]] = np.arange(len(self.pieces))
        self.slot_bits = max(8, (4 * len(nodes)).bit_length())
        self.slot_key, self.slot_child = np.full(1 << self.slot_bits, -1), np.zeros(1 << self.slot_bits, np.int32)
        deep = [p for p in nodes if len(p) > 1]
        for p in nodes.keys() - deep:
            self.root[p[0]] = nodes[p]
        key, child = np.array([nodes[p[:-1]] << 8 | p[-1] for p in deep], np.int64), np.array([nodes[p] for p in deep], np.int32)
        at = self._slot(key)
        while len(key):
            free = np.flatnonzero(self.slot_key[at] < 0)
            self.slot_key[at[free]], self.slot_child[at[free]] = key[free], child[free]  # of several at one slot the last stays
            left = self.slot_key[at] != key
            key, child, at = key[left], child[left], (at[left] + 1) & ((1 << self.slot_bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(64 - self.slot_bits)).astype(np.int64)

    def _children(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by a byte, or -1."""
        key = node.astype(np.int64) << 8 | byte
        at = self._slot(key)
        there = self.slot_key[at]
        out = np.where(there == key, self.slot_child[at], -1)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.slot_bits) - 1)
            there = self.slot_key[at[open_]]
            same = there == key[open_]
            out[open_[same]] = self.slot_child[at[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return out

    def _arcs(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, bytes, piece) of all pieces that occur in words one after the other, each opened by the mark, and a last mark: no piece goes on past a mark."""
        out = []
        at, node = np.arange(len(flat) - 1), self.root[flat[:-1]]
        for n in range(1, self.longest + 1):
            alive = node >= 0
            at, node = at[alive], node[alive]
            piece = self.piece_at[node]
            hit = np.flatnonzero(piece >= 0)
            out.append((at[hit], np.full(len(hit), n), piece[hit]))
            if not len(at) or n == self.longest:
                break
            node = self._children(node, flat[at + n])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    @staticmethod
    def _prefixes(rows: np.ndarray) -> np.ndarray:
        """Hash of the bytes up to each position, for rows of equal length."""
        out = np.zeros((rows.shape[0], rows.shape[1] + 1), U64)
        for j in range(rows.shape[1]):
            out[:, j + 1] = out[:, j] * powers(2)[1] + rows[:, j].astype(U64) + U64(1)
        return out

    @staticmethod
    def _key(h: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        h = (h ^ (h >> U64(29))) * U64(0x9E3779B97F4A7C15) + np.asarray(size).astype(U64)
        return h ^ (h >> U64(32)) ^ (h << U64(17))

    def _edges(self, rows: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, which rows, which piece) of all pieces that occur in rows of equal length."""
        prefix, n, out = self._prefixes(rows), rows.shape[1], []
        for b in range(1, n + 1):
            for a in range(max(0, b - self.longest), b):
                h = prefix[:, b] - prefix[:, a] * powers(b - a + 1)[b - a]
                hit, key = self.index.find(self._key(h, b - a))
                if len(hit):
                    out.append((a, b, hit, self.of_key[key]))
        return out

    def forward(self, rows: np.ndarray, edges: list | None = None) -> np.ndarray:
        """Log of the sum over all segmentations of the first b bytes (rows x b)."""
        alpha = np.full((rows.shape[0], rows.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0
        for a, b, hit, piece in edges if edges is not None else self._edges(rows):
            alpha[hit, b] = np.logaddexp(alpha[hit, b], alpha[hit, a] + self.log_p[piece])
        return alpha

    def forward_many(self, rows: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations of the whole rows, for each row of weights in ``log_p`` (rows x weights)."""
        edges = self._edges(rows)
        alpha = np.full((rows.shape[1] + 1, rows.shape[0], len(log_p)), -np.inf)
        alpha[0] = 0
        for a, b, hit, piece in edges:
            alpha[b, hit] = np.logaddexp(alpha[b, hit], alpha[a, hit] + log_p.T[piece])
        return alpha[-1]

    def expected(self, rows: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``count`` (rows, or rows x classes) times the rows: pieces, or classes x pieces."""
        edges = self._edges(rows)
        alpha = self.forward(rows, edges)
        beta = np.full_like(alpha, -np.inf)
        beta[:, -1] = 0
        each = count[:, None] if count.ndim == 1 else count
        out = np.zeros((each.shape[1], len(self.pieces)))
        for a, b, hit, piece in sorted(edges, key=lambda e: -e[1]):
            through = beta[hit, b] + self.log_p[piece]
            beta[hit, a] = np.logaddexp(beta[hit, a], through)
            used = np.exp(alpha[hit, a] + through - alpha[hit, -1])
            for k in range(len(out)):
                out[k] += np.bincount(piece, used * each[hit, k], out.shape[1])
        return out[0] if count.ndim == 1 else out

    def long_word(self, word: bytes, count: float | np.ndarray | None = None, out: np.ndarray | None = None) -> float:
        """The same for one word of any length, in memory proportional to it. ``out``: pieces, or classes x pieces with a ``count`` for each."""
        n = len(word)
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for b in range(1, n + 1):
            at = [(a, i) for a in range(max(0, b - self.longest), b) if (i := self.place.get(word[a:b])) is not None]
            a, piece = np.array([x[0] for x in at]), np.array([x[1] for x in at])
            v = alpha[a] + self.log_p[piece]
            top = v.max()
            alpha[b] = top + np.log(np.exp(v - top).sum())
            if out is not None:
                ends.append((a, piece))
        if out is not None:
            beta = np.full(n + 1, -np.inf)
            beta[n] = 0
            for b in range(n, 0, -1):
                a, piece = ends[b - 1]
                through = beta[b] + self.log_p[piece]
                used = np.exp(alpha[a] + through - alpha[n])
                for row, times in zip(out if out.ndim == 2 else [out], np.atleast_1d(count), strict=True):
                    np.add.at(row, piece, used * times)
                beta[a] = np.logaddexp(beta[a], through)
        return float(alpha[n])

    def _by_length(self, values: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray | list[bytes]]]:
        """(places, rows of equal length), or (places, words) of long ones; each word opened by the mark."""
        for block in blocks(values, 1 << 20):
            size = np.diff(block.offsets)
            for n in np.unique(size).tolist():
                where = np.flatnonzero(size == n)
                if n > TOGETHER:
                    yield block.first + where, [bytes([_MARK]) + block.data[block.offsets[i] : block.offsets[i + 1]].tobytes() for i in where]
                    continue
                rows = np.full((len(where), n + 1), _MARK, np.uint8)
                if n:
                    rows[:, 1:] = block.data[block.offsets[where][:, None] + np.arange(n)]
                yield block.first + where, rows

    def _together(self, values: pa.Array) -> Iterator[tuple[np.ndarray, Paths | None, pa.Array]]:
        """(places, their paths, words): those up to ``TOGETHER`` bytes, the longest first; then the longer ones without paths."""
        for block in blocks(values, 1 << 18):
            size, all_ = np.diff(block.offsets), values.slice(block.first, len(block))
            where = np.argsort(-size, kind="stable")
            where = where[np.searchsorted(-size[where], -TOGETHER) :]
            if len(where):
                n = size[where] + 1
                begin = np.cumsum(n) - n
                flat = np.full(int(n.sum()) + 1, _MARK, np.uint8)
                inside = np.arange(int((n - 1).sum())) - np.repeat(begin - np.arange(len(n)), n - 1)
                flat[np.repeat(begin + 1, n - 1) + inside] = block.data[np.repeat(block.offsets[where], n - 1) + inside]
                yield block.first + where, Paths(self, flat, n), all_.take(pa.array(where))
            if len(where) < len(block):
                far = np.flatnonzero(size > TOGETHER)
                yield block.first + far, None, all_.take(pa.array(far))

    def scores(self, values: pa.Array) -> np.ndarray:
        """log10 marginal probability of each word."""
        out = np.zeros(len(values))
        for where, rows in self._by_length(values):
            out[where] = [self.long_word(w) for w in rows] if isinstance(rows, list) else self.forward(rows)[:, -1]
        return out / np.log(10)

    def scores_by(self, values: pa.Array, log_p: np.ndarray) -> np.ndarray:
        """log10 marginal probability of each word under each row of weights (words x weights)."""
        out = np.zeros((len(values), len(log_p)))
        for where, paths, some in self._together(values):
            if paths is None:
                out[where] = self.scores_apart(some, log_p)
                continue
            each = np.column_stack([paths.log_total(p) for p in log_p])
            odd = np.flatnonzero(~np.isfinite(each).all(1))
            if len(odd):
                each[odd] = self.scores_apart(some.take(pa.array(odd)), log_p) * np.log(10)
            out[where] = each / np.log(10)
        return out

    def scores_apart(self, values: pa.Array, log_p: np.ndarray) -> np.ndarray:
        """The same, all in logarithms: for words whose sums leave the range of numbers, and long ones."""
        out = np.zeros((len(values), len(log_p)))
        for where, rows in self._by_length(values):
            if isinstance(rows, list):
                for k, p in enumerate(log_p):
                    self.log_p, kept = p, self.log_p
                    out[where, k] = [self.long_word(w) for w in rows]
                    self.log_p = kept
            else:
                out[where] = self.forward_many(rows, log_p)
        return out / np.log(10)

    def expectations(self, values: pa.Array, count: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``count`` (words, or words x classes) times the words: pieces, or classes x pieces."""
        out = np.zeros((*count.shape[1:], len(self.pieces)))
        for where, paths, some in self._together(values):
            odd = np.arange(len(where))
            if paths is not None:
                used, sure = paths.used(self.log_p)
                for row, times in zip(np.atleast_2d(out), np.atleast_2d(count[where].T), strict=True):
                    row += np.bincount(paths.piece, used * (times * sure)[paths.word], len(row))
                odd = np.flatnonzero(~sure)
            if len(odd):
                out += self.expectations_apart(some.take(pa.array(odd)), count[where[odd]])
        return out

    def expectations_apart(self, values: pa.Array, count: np.ndarray) -> np.ndarray:
        """The same, all in logarithms."""
        out = np.zeros((*count.shape[1:], len(self.pieces)))
        for where, rows in self._by_length(values):
            if isinstance(rows, list):
                for i, w in zip(where, rows, strict=True):
                    self.long_word(w, count[i], out)
            else:
                out += self.expected(rows, count[where])
        return out

    def refit(self, uses: np.ndarray, ends: float, smoothing: float = 0.1) -> None:
        total = uses.sum() + ends + smoothing * (len(uses) + 1)
        self.log_p, self.log_end = np.log((uses + smoothing) / total), float(np.log((ends + smoothing) / total))


class Paths:
    """The lattices of many words, the longest first: arcs (word, piece) between places, walked step by step over all words at once.

    The recursion multiplies probabilities, each byte worth ``BYTE_WORTH`` more; what leaves ``TRUSTED`` is told apart.
    """

    def __init__(self, lattice: Lattice, flat: np.ndarray, n: np.ndarray):
        at, size, self.piece = lattice._arcs(flat)
        self.worth, self.n = BYTE_WORTH * lattice.size, n
        begin = np.cumsum(n) - n
        word = np.repeat(np.arange(len(n)), n)[at]
        step = (at - begin[word]).astype(np.uint8)
        order = np.argsort(step + size.astype(np.uint8), kind="stable")  # by the step that an arc ends in
        self.word, self.piece, step, size = word[order], self.piece[order], step[order], size[order]
        self.begin = begin + np.arange(len(n))  # a word has a place more than bytes
        self.start = self.begin[self.word] + step
        self.end = self.start + size
        self.most = int(n[0])
        self.ending = np.append(0, np.cumsum(np.bincount(step + size, minlength=self.most + 1)))
        self.by_start = np.argsort(step, kind="stable")
        self.starting = np.append(0, np.cumsum(np.bincount(step, minlength=self.most)))
        self.words = np.searchsorted(-n, -np.arange(self.most + 1), "right")  # as many have so many bytes

    def _forward(self, weight: np.ndarray) -> np.ndarray:
        alpha = np.zeros(int(self.begin[-1] + self.n[-1]) + 1)
        alpha[self.begin] = 1
        for t in range(1, self.most + 1):
            arcs, k = slice(self.ending[t], self.ending[t + 1]), self.words[t]
            alpha[self.begin[:k] + t] = np.bincount(self.word[arcs], alpha[self.start[arcs]] * weight[arcs], k)
        return alpha

    def _weight(self, log_p: np.ndarray) -> np.ndarray:
        return np.exp(log_p + self.worth)[self.piece]

    def log_total(self, log_p: np.ndarray) -> np.ndarray:
        """Log of each word's sum over all segmentations; nan where it can't be trusted."""
        with np.errstate(all="ignore"):
            total = self._forward(self._weight(log_p))[self.begin + self.n]
            return np.where((total > 1 / TRUSTED) & (total < TRUSTED), np.log(total) - BYTE_WORTH * self.n, np.nan)

    def used(self, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected uses of each arc, and whether each word's can be trusted (they cover its bytes; the others' are 0)."""
        with np.errstate(all="ignore"):
            weight = self._weight(log_p)
            alpha = self._forward(weight)
            total = alpha[self.begin + self.n]
            beta = np.zeros_like(alpha)
            beta[self.begin + self.n] = 1
            for t in range(self.most - 1, -1, -1):
                arcs, k = self.by_start[self.starting[t] : self.starting[t + 1]], self.words[t + 1]
                beta[self.begin[:k] + t] = np.bincount(self.word[arcs], beta[self.end[arcs]] * weight[arcs], k)
            out = alpha[self.start] * weight * beta[self.end] / total[self.word]
            covered = np.bincount(self.word, out * (self.end - self.start), len(self.n))
            sure = (total > 1 / TRUSTED) & (total < TRUSTED) & (np.abs(covered - self.n) < 1e-9 * self.n)
        out[~sure[self.word]] = 0
        return out, sure


@lru_cache(2)
def _vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces and start log probabilities: by rank as 1 / (rank + 30), every single byte among them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPIECE, " ").encode()
        worst = model.get_piece_size()
        r = worst if model.is_byte(i) else min(worst, -model.get_score(i))
        rank[raw] = min(rank.get(raw, worst), r)
    pieces = [p for p in sorted(rank) if b" " not in p[1:]]  # white space never occurs inside a word
    weight = np.array([1 / (rank[p] + 30) for p in pieces])
    return pieces, np.log(weight / weight.sum())


def lattice(path: str) -> Lattice:
    pieces, start = _vocabulary(path)
    return Lattice(pieces, start.copy())


def many(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of words joined to about ``rows``: the lattice works on many words of a length at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


@dataclass
class Classes:
    """Latent classes by their words' buckets: log probabilities (classes x buckets) and log shares."""

    log_p: np.ndarray
    log_share: np.ndarray

    def of(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The likeliest class of each text."""
        n = len(bounds) - 1
        text, bucket = np.repeat(np.arange(n), np.diff(bounds)), (hashes & U64(self.log_p.shape[1] - 1)).astype(np.int64)
        fit = [np.bincount(text, p[bucket], n) + share for p, share in zip(self.log_p, self.log_share, strict=True)]
        return np.argmax(fit, axis=0)


def _shortened(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Long documents count as 200 words."""
    return counts * np.minimum(1, 200 / np.maximum(total, 1))


def _sums(x: np.ndarray, log_p: np.ndarray, log_share: np.ndarray) -> np.ndarray:
    """What a round needs of documents x buckets, for mixtures (tries x classes x buckets, tries x classes) side by side.

    Flat: expected words (tries x classes x buckets), expected documents (tries x classes), log likelihood (tries).
    """
    z = (x @ log_p.reshape(-1, x.shape[1]).T).reshape(len(x), *log_share.shape) + log_share
    top = z.max(2, keepdims=True)
    r = np.exp(z - top)
    every = r.sum(2, keepdims=True)
    r /= every
    return np.concatenate([(r.reshape(len(x), -1).T @ x).ravel(), r.sum(0).ravel(), (top + np.log(every)).sum((0, 2))])


def _far_apart(first: np.ndarray, begin: int, k: int, common: np.ndarray) -> list[int]:
    """Places of ``k`` documents: ``begin``, then always the one that the chosen ones fit worst, by log likelihood per word over that of all words."""
    p = first + 50 * common
    fit = (first / first.sum(1, keepdims=True)) @ (np.log(p / p.sum(1, keepdims=True)) - np.log(common)).T
    chosen = [begin]
    while len(chosen) < k:
        near = fit[:, chosen].max(1)
        near[chosen] = np.inf
        chosen.append(int(near.argmin()))
    return chosen


def mixture(first: np.ndarray, n_docs: int, sums: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int, tries: int = TRIES, rounds: int = PASSES) -> Classes:
    """A mixture of multinomials by expectation-maximisation, the likeliest of some tries; each starts from documents of ``first`` that are far apart.

    ``sums`` gives ``_sums`` over all documents; every round of all tries is one call of it. Classes with a share below ``LEAST_SHARE`` go.
    """
    k = min(most, len(first))
    if k < 2:
        return Classes(np.zeros((1, BUCKETS)), np.zeros(1))
    total = sums(np.zeros((1, 1, BUCKETS)), np.zeros((1, 1)))[:BUCKETS]
    common = (total + 1) / (total.sum() + BUCKETS)
    p, share = np.array([first[_far_apart(first, t % len(first), k, common)] for t in range(tries)]) + 50 * common, np.full((tries, k), 1 / k)
    for _ in range(rounds):
        p /= p.sum(2, keepdims=True)
        words_, docs_, likelihood = np.split(sums(np.log(p), np.log(share)), [p.size, p.size + share.size])
        p, share = words_.reshape(p.shape) + 20 * common, (docs_.reshape(share.shape) + 1) / (n_docs + k)
    best = np.argmax(likelihood)
    p, share = p[best] / p[best].sum(1, keepdims=True), share[best]
    kept = share >= LEAST_SHARE
    return Classes(np.log(p[kept]), np.log(share[kept] / share[kept].sum()))


def fit_classes(x: np.ndarray, most: int = LATENT) -> Classes:
    """The classes of documents x buckets in memory."""
    total = x.sum(1, keepdims=True)
    first = np.random.default_rng(0).permutation(np.flatnonzero(total[:, 0] >= START_WORDS))[: TRIES * most]
    x = _shortened(x, total)
    return mixture(x[first], len(x), lambda log_p, log_share: _sums(x, log_p, log_share), most)


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(place, n, bucket, count) of every training document: a hash of id and length, its words, its buckets (16 bits each) and their counts (32 bits each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                w, n = words(block), len(block)
                text = np.repeat(np.arange(n), np.diff(w.bounds))
                grid = np.bincount(text * BUCKETS + (w.hashes & U64(BUCKETS - 1)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
                row, bucket = np.nonzero(grid)
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=n)))
                packed = lambda x: pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(x.tobytes())])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, n), pa.array(np.diff(w.bounds)), packed(bucket.astype("<u2")), packed(grid[row, bucket].astype("<u4"))], ["place", "n", "bucket", "count"])

    return docs.where("learn").select(F.xxhash64("id", F.length("text")).alias("place"), "text").mapInArrow(run, "place long, n long, bucket binary, count binary")


def _dense(total: pa.Array, bucket: pa.Array, count: pa.Array) -> np.ndarray:
    """Documents x buckets, long documents shortened."""
    x = np.zeros(len(bucket) * BUCKETS)
    if not len(bucket):
        return x.reshape(0, BUCKETS)
    (buckets, ends), (counts, _) = _flat(bucket, "<u2"), _flat(count, "<u4")
    x[np.repeat(np.arange(len(bucket)) * BUCKETS, np.diff(ends) // 2) + buckets] = counts
    x = x.reshape(-1, BUCKETS)
    x *= _shortened(np.ones(len(x)), total.to_numpy())[:, None]
    return x


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column in a row, and the byte offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = column.cast(pa.large_binary()).buffers()
    ends = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(raw[2] or b"", np.uint8)[ends[0] : ends[-1]].view(kind), ends


def class_sums(table: DataFrame, log_p: np.ndarray, log_share: np.ndarray) -> np.ndarray:
    """``_sums`` over a table of ``bucket_counts``: one pass; a number per try, class and bucket from each task, added up by the engine."""
    size = log_p.size + log_share.size + len(log_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                out += _sums(_dense(*batch.columns), log_p, log_share)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], ["i", "v"])

    rows = table.select("n", "bucket", "count").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[rows["i"].to_numpy(np.int64)] = rows["v"].to_numpy(float)
    return out


def latent_classes(docs: DataFrame, n_docs: int) -> Classes:
    """The classes of all ``n_docs`` training documents: every round is a pass over all of them. The tries start from documents with the least hashes of id and length."""
    table = cut(bucket_counts(docs))
    first = table.where(F.col("n") >= START_WORDS).orderBy("place", "bucket", "count").limit(TRIES * LATENT).select("n", "bucket", "count").toArrow()
    classes = mixture(_dense(*first.columns), n_docs, lambda log_p, log_share: class_sums(table, log_p, log_share), LATENT)
    discard(table)
    return classes


def _gather(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of runs, one after the other."""
    return data[np.arange(int(size.sum())) + np.repeat(starts - np.cumsum(size) + size, size)]


def word_counts(docs: DataFrame, classes: Classes) -> DataFrame:
    """(h, word, c0, c1, ...): every distinct lower-cased word, its hash and its count in rows with ``learn`` by class; the ends as the empty word."""
    n_classes = len(classes.log_share)
    names = [f"c{k}" for k in range(n_classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            learn = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1), COUNT_BLOCK):
                w = words(block)
                keys, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
                known = learn[block.first : block.first + len(block)]
                of = classes.of(w.hashes, w.bounds)
                size, of_word = np.diff(w.bounds), back * n_classes
                of_word += np.repeat(of, size)
                counts = np.bincount(of_word[np.repeat(known, size)], minlength=len(keys) * n_classes).reshape(-1, n_classes)
                size = (w.ends - w.starts)[first]
                held.append((np.append(keys, U64(END_HASH)), np.append(size, 0), LOWER[_gather(block.data, w.starts[first], size)], np.vstack([counts, np.bincount(of[known], minlength=n_classes)]).astype(np.int32)))  # a block has fewer words
                if sum(len(x[0]) for x in held) >= MERGED:
                    yield from merged(held)
        if held:
            yield from merged(held)

    def merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, size, text, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]]))
        first = order[starts]
        columns = [pa.array(np.add.reduceat(x[order], starts, dtype=np.int64)) for x in counts.T]
        text = _gather(text, (np.cumsum(size) - size)[first], size[first])
        column = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.append(0, np.cumsum(size[first])).astype(np.int32)), pa.py_buffer(text.tobytes()))
        batch = pa.RecordBatch.from_arrays([pa.array(signed(keys[first])), column, *columns], ["h", "word", *names])
        del keys, size, text, counts, order, starts, first, column, columns
        for a in range(0, batch.num_rows, WORD_ROWS):
            yield batch.slice(a, WORD_ROWS)

    schema = ", ".join(["h long", "word string", *[f"{c} long" for c in names]])
    return docs.select("learn", "text").mapInArrow(run, schema).groupBy("h").agg(F.min("word").alias("word"), *[F.sum(c).alias(c) for c in names])


class Places:
    """Places of 64-bit hashes in a sorted array of distinct ones: a table by the leading bits tells where to begin, then step by step."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys, self.shift = np.append(keys, MAX64), U64(64 - bits)
        self.n, self.begin = len(keys), np.searchsorted(keys, np.arange(1 << bits, dtype=U64) << self.shift).astype(np.int32)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values`` that are members, and the place of each in ``keys``."""
        place = self.begin[(values >> self.shift).astype(np.int64)]
        low = np.flatnonzero(self.keys[place] < values)
        while len(low):
            place[low] += 1
            low = low[self.keys[place[low]] < values[low]]
        hit = np.flatnonzero((self.keys[place] == values) & (place < self.n))
        return hit, place[hit]


@dataclass
class Weights:
    """How much whole words weigh: totals and discounts of all classes together and of each."""

    n: int
    lost: float
    log_free: float
    by_class: list[tuple[int, float, float]]

    def log10(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of tokens' probabilities in each class (tokens x classes), from their counts and the lattice's log10 (tokens x classes)."""
        arc = lambda c, lost, n: np.log(np.maximum(c - lost, 0) / max(n, 1))
        with np.errstate(divide="ignore"):
            out = np.logaddexp(arc(counts.sum(1), self.lost, self.n)[:, None], self.log_free + spelled * np.log(10))
            if len(self.by_class) > 1:
                for k, (n, lost, log_free) in enumerate(self.by_class):
                    out[:, k] = np.logaddexp(arc(counts[:, k], lost, n), log_free + out[:, k])
        return out / np.log(10)


def weights(vocab: DataFrame, names: list[str]) -> tuple[Weights, int, int, list[int]]:
    """(weights, N, V, ends by class) of a table of ``word_counts``; the end counts as a word."""
    every = [F.col(c) for c in names]
    total = sum(every[1:], every[0])
    stats = lambda c: [F.coalesce(F.sum(c), F.lit(0)), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]
    row = vocab.agg(*stats(total), *[x for c in every for x in stats(c)]).first()
    ends = vocab.where("word = ''").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in every]).first()
    n, v = row[0], row[1]
    return Weights(n, *discount(*row[:4]), [(row[4 * k + 4], *discount(*row[4 * k + 4 : 4 * k + 8])) for k in range(len(names))]), n, v, list(ends)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held: int = 0, vocabulary: str | None = None, rounds: int = ROUNDS, hot: int = HOT) -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    spark = small_batches(docs)
    path = vocabulary or default_vocabulary()
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), learns(id_col, folds, held).alias("learn"))
    classes = latent_classes(source, source.where("learn").count())
    n_classes = len(classes.log_share)
    names = [f"c{k}" for k in range(n_classes)]
    vocab = cut(word_counts(source, classes))
    weight, n, v, ends = weights(vocab, names)
    model = lattice(path)
    log_p, log_end = fitted(vocab, model, names, ends, rounds if n > sum(ends) else 0)
    share = [(e + 1) / (sum(ends) + n_classes) for e in ends]
    scored = [f"s{k}" for k in range(n_classes)]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in many(batches):
            counts = np.column_stack([batch.column(2 + k).to_numpy() for k in range(n_classes)])
            s = weight.log10(counts, model.scores_by(batch.column(1), log_p))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.sum(1)), *(pa.array(np.ascontiguousarray(x)) for x in s.T)], ["h", "c", *scored])

    weighed = cut(vocab.where("word <> ''").mapInArrow(weigh, ", ".join(["h long", "c long", *[f"{x} double" for x in scored]])))
    # the commonest words by classes of their count: as many whole classes as ``hot`` rows hold
    rank = F.floor(F.log2(F.col("c") + 1) * CLASSES)
    ranks = weighed.where("c > 0").groupBy(rank.alias("r")).agg(F.count("*").alias("n")).orderBy(F.desc("r")).collect()  # at most 64 * CLASSES rows
    fits = int(np.searchsorted(np.cumsum([x["n"] for x in ranks]), hot, "right"))
    least = ranks[fits - 1]["r"] if fits else 1 << 40
    common = cut(weighed.where((F.col("c") > 0) & (rank >= least))).cut_path  # at most ``hot`` rows of 16 bytes and 8 per class
    end_base, end_score = float(np.log10(sum(ends) + 0.1)), weight.log10(np.array([ends]), log_end[None] / np.log(10))[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, c, s = common_words(common)
        index = Places(keys)
        base = np.log10(c + 0.1)
        for batch in batches:
            for block in blocks(batch.column(1)):
                w = words(block)
                hit, at = index.find(w.hashes)
                text = np.repeat(np.arange(len(block)), np.diff(w.bounds))[hit]
                add = lambda x: np.bincount(text, x[at], len(block))
                rest = np.ones(len(w.hashes), bool)
                rest[hit] = False
                bounds = np.append(0, np.cumsum(rest))[w.bounds]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(block)), batch.column(2).slice(block.first, len(block)), pa.array(np.diff(w.bounds) + 1), pa.array(add((c > 0).astype(float)).astype(np.int64) + (sum(ends) > 0)), pa.array(add(base) + end_base), *(pa.array(add(x) + e) for x, e in zip(s, end_score, strict=True)), ragged(pa.array(signed(w.hashes[rest])), bounds)],
                    ["id", "learn", "n_tokens", "n_known", "base", *scored, "rest"],
                )

    heads = source.select("id", "text", "learn").mapInArrow(read, f"id long, learn boolean, n_tokens long, n_known long, base double, {', '.join(f'{x} double' for x in scored)}, rest array<long>")
    heads = cut(heads.withColumn("row", F.monotonically_increasing_id()))
    rest = heads.select("row", F.explode("rest").alias("h")).join(weighed, "h")
    rest = rest.groupBy("row").agg(F.sum((F.col("c") > 0).cast("long")).alias("k"), F.sum(F.log10(F.col("c") + 0.1)).alias("b"), *[F.sum(x).alias(f"r{x}") for x in scored])
    out = heads.drop("rest").join(rest, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    per_token = float(np.log10(n + 0.1 * (v + 1)))
    out = out.withColumns({x: F.col(x) + zero(f"r{x}") for x in scored})
    return out.select(
        F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), "n_tokens", (F.col("n_known") + zero("k")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b") - F.col("n_tokens") * per_token).alias("base_score"), marginal([F.col(x) for x in scored], share).alias("score"),
    )


@lru_cache(1)
def common_words(path: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes in order, counts and scores by class of a stored table of words; a worker reads it once."""
    fs, base = pafs.FileSystem.from_uri(path)
    table = pq.read_table(base, filesystem=fs)
    keys = table.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column(1).to_numpy()[order], [c.to_numpy()[order] for c in table.columns[2:]]


def marginal(scores: list[Column], shares: list[float]) -> Column:
    """log10 of the sum of 10 ** score, each with its share."""
    if len(scores) == 1:
        return scores[0]
    top = F.greatest(*scores)
    return top + F.log10(sum((F.lit(float(p)) * F.pow(F.lit(10.0), s - top) for s, p in zip(scores, shares, strict=True)), F.lit(0.0)))


def fitted(vocab: DataFrame, model: Lattice, names: list[str], ends: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the pieces (classes x pieces) and of the end (classes), after ``rounds`` of expectation-maximisation.

    All rounds but the last are for all classes together.
    """
    for last in [False] * (rounds - 1) + [True] * (rounds > 0):
        uses = _expected_uses(vocab, model, names if last else None)
        if last:
            each = []
            for k in range(len(names)):
                model.refit(uses[k], float(ends[k] > 0))
                each.append((model.log_p, model.log_end))
            return np.array([p for p, _ in each]), np.array([e for _, e in each])
        model.refit(uses[0], float(sum(ends) > 0))
    return np.array([model.log_p] * len(names)), np.array([model.log_end] * len(names))


def discount(n: int, v: int, once: int, twice: int) -> tuple[float, float]:
    """What each count loses, and the log of the share that is freed (all of it without counts)."""
    lost = once / (once + 2 * twice) if once and twice else 0.5
    return lost, float(np.log(lost * v / n)) if n else 0.0


def _expected_uses(vocab: DataFrame, model: Lattice, names: list[str] | None) -> np.ndarray:
    """Uses of each piece (classes x pieces, or 1 x pieces), summed over all distinct training words: what is spelled out are new words."""
    n_classes = len(names) if names else 1
    counts = [c for c in vocab.columns if c not in ("h", "word")]
    in_class = [(F.col(c) > 0) for c in names] if names else [sum((F.col(c) for c in counts[1:]), F.col(counts[0])) > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_classes, len(model.pieces)))
        for batch in many(batches):
            there = np.column_stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(n_classes)]).astype(float)
            total += model.expectations(batch.column(0), there)
        k, used = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(used), pa.array(total[k, used])], ["k", "piece", "uses"])

    some = sum((F.col(c) for c in counts[1:]), F.col(counts[0])) > 0
    words_only = vocab.where("word <> ''").where(some).select("word", *[x.alias(f"b{i}") for i, x in enumerate(in_class)])
    rows = words_only.mapInArrow(run, "k long, piece long, uses double").groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toPandas()
    out = np.zeros((n_classes, len(model.pieces)))
    out[rows["k"].to_numpy(np.int64), rows["piece"].to_numpy(np.int64)] = rows["uses"].to_numpy(float)
    return out
