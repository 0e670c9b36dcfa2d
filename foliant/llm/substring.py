"""Operator 6: substring deduplication by collinear chaining.

1. Winnowed word 5-grams are seeds: any run of ``K + WINDOW - 1`` equal words has a
   common seed. Every place of a seed is joined by hash with the seed's first occurrence
   (least document, then position) only, so a passage that many documents share gives one match per
   occurrence, never all pairs.
2. The matches of a document with one source are chained: a Fenwick tree over source
   positions holds the best chain that ends before each position, and gaps cost by
   their length. Every match ends in the chain it fits best.
3. A seed's first document need not be the first one that has the whole passage around
   it. So every run of ``min_words`` words whose seeds are all shared is joined by the hash of
   all its words with its own first occurrence: a run of ``min_words`` equal words that an
   earlier document has is always found, whoever has its parts.
4. Chains that may be long enough are aligned word by word: equal stretches between
   anchors are compared at once, unequal gaps by a banded alignment, and the ends are
   extended while words agree. What reaches ``min_words`` and ``identity`` is a passage.

In a pair it is always the later document (greater id) whose passage is reported, so
removing reported passages leaves each passage in its first document.

Defined cases: null, empty and short texts have no passages; equal texts are
reported whole, but in their first document; passages repeated within one document
only aren't reported; rows that share an id are told apart by nothing, so they are
compared with other ids only and each is cut alike; null ids are left alone; an
empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import SPACE, blocks, grams, mix, powers, ragged, signed, winnow, words
from foliant.llm.shared import cut, discard, hot_keys, salted, small_batches

K, WINDOW = 5, 16
MIN_WORDS, IDENTITY = 50, 0.8
#: A gap of so many words at most is bridged inside one passage.
MAX_GAP = 40
GAP_COST, BAND = 0.1, 6
#: Rows of an Arrow batch that a mapper of words gives; Java holds such batches outside its heap.
OUT_ROWS = 10_000


def seeds(docs: DataFrame, k: int, window: int) -> DataFrame:
    """(h, id, pos): winnowed k-grams of each text at all their places; of a run of one phrase, the first and the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                w = words(block, SPACE)
                values, valid = grams(w, k)
                pos = winnow(values, valid, w.bounds, window)
                text = np.searchsorted(w.bounds, pos, "right") - 1
                kept = _ends(text, pos, values[pos], window)
                pos, text = pos[kept], text[kept]
                yield pa.RecordBatch.from_arrays([pa.array(signed(values[pos])), batch.column(0).take(pa.array(block.first + text)), pa.array((pos - w.bounds[text]).astype(np.int32))], ["h", "id", "pos"])

    return docs.select("id", "text").mapInArrow(run, "h long, id long, pos int")


def long_runs(docs: DataFrame, shared: DataFrame, k: int, window: int, length: int) -> DataFrame:
    """(h, id, pos, n): each run of ``length`` words that may be in two documents, by the hash of its words; ``n`` equal ones in a row are one row.

    ``shared (id, hs)`` are the seeds that a document has in common with others. A run that two
    documents have holds the same seeds in both, but for those that words outside the run decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, off = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()
            for block in blocks(batch.column(1)):
                w = words(block, SPACE)
                values, valid = grams(w, k)
                pos = winnow(values, valid, w.bounds, window)
                text = np.searchsorted(w.bounds, pos, "right") - 1
                cuts = np.searchsorted(pos, w.bounds)
                known = np.zeros(len(pos), bool)
                for i in range(len(block)):
                    row = block.first + i
                    known[cuts[i] : cuts[i + 1]] = np.isin(signed(values[pos[cuts[i] : cuts[i + 1]]]), hs[off[row] : off[row + 1]])
                # a seed that no other document has rules out the runs that hold its whole neighbourhood
                n = len(w.hashes)
                lost = np.zeros(n + 1, np.int64)
                alone, first = pos[~known], w.bounds[text[~known]]
                low, high = np.maximum(first, alone + k + window - 1 - length), alone - window + 2
                ok = low < high
                np.add.at(lost, low[ok], 1)
                np.add.at(lost, high[ok], -1)
                room = np.repeat(w.bounds[1:], np.diff(w.bounds)) - np.arange(n)
                at = np.flatnonzero((np.cumsum(lost[:-1]) == 0) & (room >= length))
                owner = np.searchsorted(w.bounds, at, "right") - 1
                h = run_hashes(w.hashes, at, length)
                start = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]))) if len(at) else at
                times = np.diff(np.append(start, len(at)))
                h, at, owner = h[start], at[start], owner[start]
                out = pa.RecordBatch.from_arrays([pa.array(signed(h)), batch.column(0).take(pa.array(block.first + owner)), pa.array((at - w.bounds[owner]).astype(np.int32)), pa.array(times.astype(np.int32))], ["h", "id", "pos", "n"])
                for a in range(0, len(at), OUT_ROWS):
                    yield out.slice(a, OUT_ROWS)

    return docs.join(shared, "id").select("id", "text", "hs").mapInArrow(run, "h long, id long, pos int, n int")


def run_hashes(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place ``at`` on: differences of one running polynomial, shifted to power 0."""
    total = np.append(np.uint64(0), np.cumsum(hashes * powers(len(hashes) + 1)[: len(hashes)], dtype=np.uint64))
    back = np.full(len(hashes) + 1, pow(int(powers(2)[1]), -1, 1 << 64), np.uint64)
    back[0] = 1
    return mix((total[at + length] - total[at]) * np.cumprod(back, dtype=np.uint64)[at])


def exact_runs(docs: DataFrame, match: DataFrame, k: int, window: int, length: int) -> DataFrame:
    """(id, src, anchors): equal runs of ``length`` words or more with the first document that has them, as flat (pos, src_pos, words)."""
    both = match.select("id", "h").unionAll(match.select(F.col("src").alias("id"), "h"))
    shared = both.groupBy("id").agg(F.collect_set("h").alias("hs"))
    rows = cut(long_runs(docs, shared, k, window, length))
    first = rows.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("f"), F.max("id").alias("last")).where("f.id < last")
    found = rows.join(first.select("h", F.col("f.id").alias("src"), F.col("f.pos").alias("src_pos")), "h").where("id > src")
    grouped = found.groupBy("id", "src").agg(F.collect_list(F.struct("pos", "src_pos", "n")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(2)
            off = m.offsets.to_numpy()
            p, s, n = (m.values.field(i).to_numpy().astype(np.int64)[off[0] : off[-1]] for i in (0, 1, 2))
            owner = np.repeat(np.repeat(np.arange(batch.num_rows), np.diff(off)), n)
            p, s = np.repeat(p - np.cumsum(n) + n, n) + np.arange(int(n.sum())), np.repeat(s, n)
            order = np.lexsort((s, p, owner))
            p, s, owner = p[order], s[order], owner[order]
            start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (p[1:] != p[:-1] + 1) | (s[1:] != s[:-1] + 1)))
            size = np.diff(np.append(start, len(p))) + length - 1
            flat = np.stack([p[start], s[start], size], axis=1).ravel()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ragged(pa.array(flat.astype(np.int32)), 3 * np.append(0, np.cumsum(np.bincount(owner[start], minlength=batch.num_rows))))], ["id", "src", "anchors"])

    out = cut(grouped.mapInArrow(run, "id long, src long, anchors array<int>"))
    discard(rows)
    return out


def _ends(text: np.ndarray, pos: np.ndarray, values: np.ndarray, window: int) -> np.ndarray:
    """All places but the inner ones of runs: places whose value comes again within ``window`` words on either side."""
    order = np.lexsort((pos, values, text))
    if not len(order):
        return order
    t, v, p = text[order], values[order], pos[order]
    near = (t[1:] == t[:-1]) & (v[1:] == v[:-1]) & (p[1:] - p[:-1] <= window)
    return np.sort(order[~(np.append(False, near) & np.append(near, False))])


def chain(pos: np.ndarray, src: np.ndarray, k: int, gap_cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[int]]:
    """Collinear chains of matches (positions in the document and in the source), as lists of indices.

    A chain's value is its matched words less ``gap_cost`` per word of gap on either side. For a
    match at (x, y) the predecessor's value counts as f + gap_cost * (x' + y'), so that the tree's
    prefix maximum over source positions finds the best one. Chains are split where a gap
    exceeds ``max_gap``.
    """
    order = np.lexsort((src, pos))
    ys = np.unique(src)
    rank = np.searchsorted(ys, src) + 1
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ys) + 1)
    value, back = [0.0] * len(pos), [-1] * len(pos)
    wait: list[int] = []  # matches at the same document position enter the tree together
    last = None
    p, s, r = pos.tolist(), src.tolist(), rank.tolist()

    def enter() -> None:
        for i in wait:
            item, j = (value[i] + gap_cost * (p[i] + s[i]), i), r[i]
            while j <= len(ys):
                if item > tree[j]:
                    tree[j] = item
                j += j & -j
        wait.clear()

    for i in order.tolist():
        if p[i] != last:
            enter()
            last = p[i]
        best, j = (-1e18, -1), r[i] - 1
        while j > 0:
            best = max(best, tree[j])
            j -= j & -j
        value[i] = float(k)
        if (b := best[1]) >= 0:
            dx, dy = p[i] - p[b], s[i] - s[b]
            through = value[b] + min(k, dx, dy) - gap_cost * (abs(dx - dy) + max(0, min(dx, dy) - k))
            if through > k:
                value[i], back[i] = through, b
        wait.append(i)
    # best chains first; a match belongs to one chain
    used, out = [False] * len(pos), []
    for i in sorted(range(len(pos)), key=lambda i: (-value[i], p[i], s[i])):
        row = []
        while i >= 0 and not used[i]:
            if row and max(p[row[-1]] - p[i], s[row[-1]] - s[i]) > max_gap + k:
                out.append(row[::-1])
                row = []
            used[i] = True
            row.append(i)
            i = back[i]
        if row:
            out.append(row[::-1])
    return out


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    off = np.flatnonzero(a[:n] != b[:n])
    return int(off[0]) if len(off) else n


def _gap_matches(a: list[int], b: list[int], band: int = BAND) -> int:
    """Equal words of two short stretches by banded alignment (longest common subsequence in a band)."""
    extra = abs(len(a) - len(b)) + band
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [0] * (len(b) + 1)
        for j in range(max(0, i - extra), min(len(b), i + extra + 1)):
            new[j + 1] = row[j] + 1 if x == b[j] else max(row[j + 1], new[j])
        row = new
    return max(row)


def align(doc: np.ndarray, source: np.ndarray, anchors: list[tuple[int, int]], k: int) -> tuple[int, int, int, int, int]:
    """(start, end, source start, source end, equal words) of a chain of anchors, extended over equal words."""
    (p, s), matched = anchors[0], 0
    n = _equal_run(doc[:p][::-1], source[:s][::-1])
    start, s_start = p - n, s - n
    matched += n
    at, s_at = p, s
    for p, s in [*anchors, (None, None)]:
        if p is not None and (p < at or s < s_at):
            continue  # inside what was compared already
        if p is not None and (p > at or s > s_at):
            matched += _gap_matches(doc[at:p].tolist(), source[s_at:s].tolist())
            at, s_at = p, s
        if p is not None:
            n = _equal_run(doc[p:], source[s:])
            matched, at, s_at = matched + n, p + n, s + n
    return start, at, s_start, s_at, matched


def _bridged(doc: np.ndarray, source: np.ndarray, x: tuple[int, int, int, int, int]) -> tuple[int, int, int, int, int]:
    """Both ends carried over single unequal words, as long as at least four of the next five words are equal."""
    a, b, c, d, m = x
    while b + 6 <= len(doc) and d + 6 <= len(source) and (n := int((doc[b + 1 : b + 6] == source[d + 1 : d + 6]).sum())) >= 4:
        step = 6
        b, d, m = b + step, d + step, m + n
        n = _equal_run(doc[b:], source[d:])
        b, d, m = b + n, d + n, m + n
    while a >= 6 and c >= 6 and (n := int((doc[a - 6 : a - 1] == source[c - 6 : c - 1]).sum())) >= 4:
        a, c, m = a - 6, c - 6, m + n
        n = _equal_run(doc[:a][::-1], source[:c][::-1])
        a, c, m = a - n, c - n, m + n
    return a, b, c, d, m


def covered(equal: list[tuple[int, int, int]], got: list[tuple], passage: Callable[[int, int], list[tuple]]) -> list[tuple]:
    """Passages that cover the equal runs (pos, source pos, words) which no passage of ``got`` holds; of runs that overlap, as few as cover all."""
    left = sorted((p, p + n, s) for p, s, n in set(equal) if not any(a <= p and p + n <= b for a, b, *_ in got))
    out: list[tuple] = []
    reach, i = -1, 0
    while i < len(left):
        if left[i][1] <= reach:
            i += 1
            continue
        best, j = left[i], i + 1
        while j < len(left) and left[j][0] <= reach:
            best = max(best, left[j], key=lambda x: x[1])
            j += 1
        found = passage(best[0], best[2])
        out += found
        reach, i = max([best[1], *(x[1] for x in found)]), j
    return out


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, identity: float = IDENTITY, k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per repeated passage: id, source_id, start_word, end_word, source_start, source_end, matched, start_byte, end_byte.

    Words are maximal runs without ASCII white space, A-Z as a-z. Passages of a document with
    different sources may overlap.
    """
    small_batches(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    seed = cut(seeds(texts, k, window))
    first = seed.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("f"), F.max("id").alias("last")).where("f.id < last")
    match = cut(seed.join(first.select("h", F.col("f.id").alias("src"), F.col("f.pos").alias("src_pos")), "h").where("id > src"))
    discard(seed)
    exact = exact_runs(texts, match, k, window, min_words)
    grouped = match.groupBy("id", "src").agg(F.collect_list(F.struct("pos", "src_pos")).alias("m")).where(F.size("m") > 1)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(2)
            off = m.offsets.to_numpy()
            pos, src = (m.values.field(i).to_numpy() for i in (0, 1))
            kept, anchors, sizes = [], [], []
            for i in range(batch.num_rows):
                p, s = pos[off[i] : off[i + 1]], src[off[i] : off[i + 1]]
                for row in chain(p, s, k):
                    # the ends may reach on for as long as no seed is due
                    reach = p[row[-1]] - p[row[0]] + k + 2 * (window + k)
                    if len(row) > 1 and reach >= min_words:
                        kept.append(i)
                        anchors.append(np.stack([p[row], s[row]], axis=1).ravel())
                        sizes.append(2 * len(row))
            place = pa.array(kept, pa.int64())
            flat = np.concatenate(anchors) if anchors else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(1).take(place), ragged(pa.array(flat.astype(np.int32)), np.append(0, np.cumsum(sizes)))], ["id", "src", "anchors"])

    chained = cut(grouped.mapInArrow(chains, "id long, src long, anchors array<int>"))
    discard(match)
    chained = chained.withColumn("exact", F.lit(False)).unionAll(exact.withColumn("exact", F.lit(True)))
    perdoc = chained.groupBy("id", "src").agg(F.collect_list(F.struct("anchors", "exact")).alias("c"))

    def tried(doc: np.ndarray, source: np.ndarray, anchors: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
        plain = align(doc, source, anchors, k)
        for a, b, c, d, m in (_bridged(doc, source, plain), plain):
            if min(b - a, d - c) >= min_words and m >= identity * max(b - a, d - c):
                return [(a, b, c, d, m)]
        return []

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            known: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
            docs_words = [(w, w.bounds, j) for block in blocks(batch.column(3)) for w in [words(block, SPACE)] for j in range(len(block))]
            first_byte = [int(block.offsets[j]) for block in blocks(batch.column(3)) for j in range(len(block))]
            for i in range(batch.num_rows):
                ident, src = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if known[0] != src:
                    known = (src, words(next(blocks(batch.column(4).slice(i, 1))), SPACE).hashes)
                w, bounds, j = docs_words[i]
                doc, source = w.of(j), known[1]
                got: list[tuple[int, int, int, int, int]] = []
                equal: list[tuple[int, int, int]] = []
                for c in batch.column(2)[i].as_py():
                    flat = c["anchors"]
                    if c["exact"]:
                        equal += zip(flat[::3], flat[1::3], flat[2::3], strict=True)
                    else:
                        got += tried(doc, source, list(zip(flat[::2], flat[1::2], strict=True)))
                for a, b, c, d, m in got + covered(equal, got, lambda p, s: tried(doc, source, [(p, s)])):
                    rows.append({"id": ident, "source_id": src, "start_word": a, "end_word": b, "source_start": c, "source_end": d, "matched": m, "start_byte": int(w.starts[bounds[j] + a]) - first_byte[i], "end_byte": int(w.ends[bounds[j] + b - 1]) - first_byte[i]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([(c, pa.int64()) for c in COLUMNS]))

    wanted = chained.select(F.explode(F.array("id", "src")).alias("id")).distinct()
    involved = cut(texts.join(wanted, "id", "left_semi"))
    left = perdoc.join(involved, "id")
    # many documents may have the same source: its rows are dealt over several parts
    both = salted(left, "src", "id", involved.select(F.col("id").alias("source"), F.col("text").alias("source_text")), "source", hot_keys(chained.groupBy("src").agg(F.count("*").alias("n")), "src", "n"))
    found = both.select("id", "src", "c", "text", "source_text").mapInArrow(aligned, ", ".join(f"{c} long" for c in COLUMNS))
    return found.distinct().withColumnRenamed("id", id_col)


COLUMNS = ("id", "source_id", "start_word", "end_word", "source_start", "source_end", "matched", "start_byte", "end_byte")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """Cut every repeated passage out of all but its first document; documents of which nothing is left go.

    All columns stay; ``length_col``, where there is one, becomes the new length of a text that was cut.
    """
    ident, found_at = (f"{name}_{uuid.uuid4().hex}" for name in ("id", "spans"))  # no column of ``docs`` has such a name
    spans = cut(passages(docs, id_col, text_col, **options).groupBy(F.col(id_col).alias(ident)).agg(F.array_sort(F.collect_list(F.struct("start_byte", "end_byte"))).alias(found_at)))
    joined = docs.join(spans, docs[id_col].cast("long") == spans[ident], "left").drop(ident)
    place, length = docs.columns.index(text_col), docs.columns.index(length_col) if length_col in docs.columns else None

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            found, texts = batch.column(len(columns)).to_pylist(), batch.column(place).to_pylist()
            texts = [t if f is None or t is None else _left(t, [(s["start_byte"], s["end_byte"]) for s in f]) for t, f in zip(texts, found, strict=True)]
            columns[place] = pa.array(texts, columns[place].type)
            if length is not None:
                sizes = [n if f is None else len(t) for n, t, f in zip(columns[length].to_pylist(), texts, found, strict=True)]
                columns[length] = pa.array(sizes, columns[length].type)
            keep = pa.array([f is None or bool(t) for t, f in zip(texts, found, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(keep)

    return joined.mapInArrow(without, docs.schema)


def _left(text: str, spans: list[tuple[int, int]]) -> str:
    """What is left of a text without the byte ranges ``spans`` (in order; they may overlap)."""
    raw, at, parts = text.encode(), 0, []
    for a, b in spans:
        if a > at:
            parts.append(raw[at:a].strip())
        at = max(at, b)
    parts.append(raw[at:].strip())
    return b" ".join(p for p in parts if p).decode("utf-8", "replace")
