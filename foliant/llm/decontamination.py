"""Operator 4: benchmark decontamination by greedy string tiling.

The benchmark's word 5-grams are an index; the documents' 5-grams are joined with
it map-side (documents aren't shuffled). A document and an item that share enough
seeds to reach the threshold are tiled: the longest run of equal, still unmarked
words is marked again and again, found by running Karp-Rabin hashes of falling
lengths, until none of the least length is left. The share of the item's words
under tiles is its coverage. Tiles may come in any order, so reordered passages
count as much as verbatim ones.

A benchmark is read in blocks of at most ``block_bytes`` of text, one pass over
the documents per block, so what is sent to the tasks has a fixed bound; the
usual benchmark is one block. Equal items are one text in a block, and their ids are joined with
what it matches afterwards; blocks are cut by the texts' sizes, and an item longer than a block is a block of its own.

A seed that more than ``MANY`` items hold ("answer the following question") finds no items by itself: an item
needs another seed in a document, unless such seeds alone could cover enough of it. Tiling and coverage count all seeds.

Defined cases: null, empty and wordless items are covered by nothing; an item with
fewer words than a seed must occur whole; null and empty texts match nothing;
repeated items and documents each give their own rows; an empty table on either
side gives no rows; further columns don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import NON_WORD, HashIndex, blocks, grams, words
from foliant.llm.shared import cut, small_batches

SEED = 5
THRESHOLD = 0.5
BLOCK_BYTES = 4 << 20
MANY = 64
#: Digits of a text's hash by which sizes are summed, and more where that is too coarse.
DIGITS = 3

SCHEMA = "id long, item string, covered long, item_words long, coverage double, tiles array<struct<doc_start:int,item_start:int,length:int>>"


def tile(doc: list[int], item: list[int], least: int, first: int = 20) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length) of non-overlapping matches, longest first.

    ``doc`` and ``item`` are word hashes; a negative one in ``doc`` matches nothing. Search
    lengths start at ``first`` (or where a longer match is found) and halve down to ``least``;
    for each, the running hashes of all unmarked windows of the item are looked up from the document's.
    """
    base, mod = 1_000_003, (1 << 61) - 1
    doc_free, item_free = [h >= 0 for h in doc], [True] * len(item)

    def windows(row: list[int], free: list[bool], s: int) -> Iterator[tuple[int, int]]:
        top, h, run = pow(base, s, mod), 0, 0
        for i, x in enumerate(row):
            run = run + 1 if free[i] else 0
            h = (h * base + x) % mod
            if i >= s:
                h = (h - row[i - s] * top) % mod
            if run >= s:
                yield i - s + 1, h

    out: list[tuple[int, int, int]] = []
    s = max(least, min(first, len(item)))
    while True:
        at: dict[int, list[int]] = defaultdict(list)
        for j, h in windows(item, item_free, s):
            at[h].append(j)
        found, longest = [], 0
        for i, h in windows(doc, doc_free, s) if at else ():
            for j in at.get(h, ()):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc_free[i + n] and item_free[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                if n >= s:
                    found.append((n, i, j))
                    longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        for n, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if all(doc_free[i : i + n]) and all(item_free[j : j + n]):
                out.append((i, j, n))
                doc_free[i : i + n] = [False] * n
                item_free[j : j + n] = [False] * n
        if not found or all(n <= s for n, _, _ in found):  # else parts of longer ones may be left at this length
            if s == least:
                return out
            s = max(least, s // 2)
        elif not any(all(doc_free[i : i + s]) and all(item_free[j : j + s]) for _, i, j in found):
            if s == least:
                return out
            s = max(least, s // 2)


class ItemIndex:
    """Seeds of a bounded set of items: seed hash to (item, position), by seed length."""

    def __init__(self, texts: list[str], seed: int):
        self.seed = seed
        self.items: list[np.ndarray] = []
        for block in blocks(pa.array(texts, pa.string()), 1 << 60):
            w = words(block, NON_WORD)
            self.items = [w.of(i) for i in range(len(block))]
        self.by_length: list[tuple[int, HashIndex, list[list[tuple[int, int]]]]] = []
        for k in sorted({min(seed, len(x)) for x in self.items} - {0}):
            at: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for n, x in enumerate(self.items):
                if min(seed, len(x)) == k:
                    for p, h in enumerate(grams_of(x, k).tolist()):
                        at[h].append((n, p))
            index = HashIndex(np.fromiter(at, np.uint64, len(at)))
            self.by_length.append((k, index, [at[h] for h in index.keys.tolist()]))


def grams_of(hashes: np.ndarray, k: int) -> np.ndarray:
    from foliant.llm._arrow import Words

    got, valid = grams(Words(hashes, hashes, hashes, np.array([0, len(hashes)])), k)
    return got[valid]


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """(item_id, item, text): ``item`` is the text's hash."""
    text = F.col(item_text_col).cast("string")
    return benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.sha2(text, 256).alias("item"), text.alias("text")).where("text is not null")


def _ranges(texts: DataFrame, block_bytes: int, digits: int = DIGITS) -> Iterator[tuple[str, str]]:
    """Ranges of hashes, by their first digits, whose texts have ``block_bytes`` at most or are one text."""
    sizes = texts.groupBy(F.substring("item", 1, digits).alias("p")).agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("c"))
    low, high, total = None, None, 0
    for p, n, c in sizes.orderBy("p").collect():  # 16**DIGITS rows at most
        if low is not None and total + n > block_bytes:
            yield low, high
            low, total = None, 0
        if n > block_bytes and c > 1:
            yield from _ranges(texts.where(F.startswith("item", F.lit(p))), block_bytes, digits + DIGITS)
            continue
        low, high, total = low or p, p, total + n
    if low is not None:
        yield low, high


def _dealt(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    """The benchmark's blocks: hashes and texts, every text once."""
    texts = items.groupBy("item").agg(F.max("text").alias("text"))
    for low, high in _ranges(texts, block_bytes):
        got = texts.where((F.substring("item", 1, len(low)) >= low) & (F.substring("item", 1, len(high)) <= high)).orderBy("item").collect()
        yield [r["item"] for r in got], [r["text"] for r in got]


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item whose coverage reaches ``threshold``: id, item_id, covered, item_words, coverage, tiles."""
    small_batches(docs)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items, out = _items(benchmark, item_col, item_text_col), None
    for hashes, texts in _dealt(items, block_bytes):
        found = Tiling(hashes, texts, threshold, seed)

        def run(batches: Iterator[pa.RecordBatch], found: Tiling = found) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [{"id": batch.column(0)[i].as_py(), **row} for i, row in found.rows(batch.column(1))]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, OUT)

        part = source.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = source.sparkSession.createDataFrame([], SCHEMA)
    named = out.join(items.select("item", "item_id"), "item")
    return named.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "covered", "item_words", "coverage", "tiles")


OUT = pa.schema([("id", pa.int64()), ("item", pa.string()), ("covered", pa.int64()), ("item_words", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())])))])


class Tiling:
    """Tiles of texts with a bounded set of items."""

    def __init__(self, names: list[str], texts: list[str], threshold: float, seed: int):
        self.names, self.seed = names, seed
        self.index = ItemIndex(texts, seed)
        self.need = [max(1, -(-int(round(threshold * len(x) * 1000)) // 1000)) for x in self.index.items]
        common: dict[int, set[int]] = defaultdict(set)  # words of an item that seeds of many items cover
        for k, _, where in self.index.by_length:
            for at in where:
                if len({n for n, _ in at}) > MANY:
                    for n, q in at:
                        common[n].update(range(q, q + k))
        enough = {n for n, words_of in common.items() if len(words_of) >= self.need[n]}
        #: By seed length and seed: what finds items, and, of a seed of many items, where it is in each of the others.
        self.finds, self.adds = [], []
        for _, _, where in self.index.by_length:
            many = [len({n for n, _ in at}) > MANY for at in where]
            self.finds.append([[(n, q) for n, q in at if n in enough] if hot else at for at, hot in zip(where, many, strict=True)])
            adds: dict[int, dict[int, list[int]]] = {}
            for m in np.flatnonzero(many).tolist():
                adds[m] = defaultdict(list)
                for n, q in where[m]:
                    if n not in enough:
                        adds[m][n].append(q)
            self.adds.append(adds)

    def tiled(self, doc: np.ndarray, hits: dict[int, int], n: int) -> list[dict] | None:
        """Tiles of item ``n`` if they cover enough; ``hits``: each seed's start in the document to its length."""
        item = self.index.items[n]
        near = np.zeros(len(doc), bool)
        for p, k in hits.items():
            near[p : p + k] = True
        place = np.flatnonzero(near)
        gap = np.append(True, np.diff(place) > 1)  # a gap becomes a word that matches nothing
        row, at = [], []
        for p, g, h in zip(place.tolist(), gap.tolist(), (doc[place] >> np.uint64(4)).tolist(), strict=True):
            if g:
                row.append(-1)
                at.append(-1)
            row.append(h)
            at.append(p)
        tiles = tile(row, (item >> np.uint64(4)).tolist(), min(self.seed, len(item)))
        if sum(t[2] for t in tiles) < self.need[n]:
            return None
        return [{"doc_start": at[i], "item_start": j, "length": m} for i, j, m in sorted(tiles)]

    def rows(self, texts: pa.Array) -> Iterator[tuple[int, dict]]:
        """(place of the text, what it covers) of every text and item that meet the threshold."""
        for block in blocks(texts):
            w = words(block, NON_WORD)
            hits: dict[int, dict[int, dict[int, int]]] = defaultdict(lambda: defaultdict(dict))
            covers: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
            later: dict[int, list[tuple[int, int, dict[int, list[int]]]]] = defaultdict(list)
            for (k, keys, _), finds, adds in zip(self.index.by_length, self.finds, self.adds, strict=True):
                values, valid = grams(w, k)
                pos, place = keys.find(values)
                pos, place = pos[valid[pos]], place[valid[pos]]
                owner = np.searchsorted(w.bounds, pos, "right") - 1
                for i, p, m in zip(owner.tolist(), (pos - w.bounds[owner]).tolist(), place.tolist(), strict=True):
                    for n, q in finds[m]:
                        hits[i][n][p] = k
                        covers[i][n].update(range(q, q + k))
                    if m in adds:
                        later[i].append((p, k, adds[m]))
            for i, common in later.items():  # only for items that another seed has found in the text
                if i in hits:
                    for p, k, of in common:
                        few, other = (hits[i], of) if len(hits[i]) <= len(of) else (of, hits[i])
                        for n in [n for n in few if n in other]:
                            hits[i][n][p] = k
                            for q in of[n]:
                                covers[i][n].update(range(q, q + k))
            for i, of in hits.items():
                for n in of:
                    if len(covers[i][n]) >= self.need[n] and (tiles := self.tiled(w.of(i), of[n], n)):
                        covered, size = sum(t["length"] for t in tiles), len(self.index.items[n])
                        yield block.first + i, {"item": self.names[n], "covered": covered, "item_words": size, "coverage": covered / size, "tiles": tiles}


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Drop the rows whose text covers an item; all columns stay, and so do rows with a null id.

    The filter runs where the texts are read, so nothing is shuffled. Of several blocks of the
    benchmark each is a pass over what the one before it kept.
    """
    small_batches(docs)
    kind, place, ident = docs.schema, docs.columns.index(text_col), docs.columns.index(id_col)
    out, passes = docs, 0
    for hashes, texts in _dealt(_items(benchmark, item_col, item_text_col), block_bytes):
        found = Tiling(hashes, texts, threshold, seed)

        def run(batches: Iterator[pa.RecordBatch], found: Tiling = found) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gone = np.zeros(batch.num_rows, bool)
                gone[[i for i, _ in found.rows(batch.column(place).cast(pa.string()))]] = True
                yield batch.filter(pa.array(~gone | batch.column(ident).is_null().to_numpy(zero_copy_only=False)))

        out = (cut(out) if passes else out).mapInArrow(run, kind)
        passes += 1
    return out
