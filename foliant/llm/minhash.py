"""Operator 5: near-duplicates by b-bit MinHash.

1. Each text becomes its set of distinct word shingles (64-bit hashes). Equal sets
   fall into one class by a fingerprint of the set; only the class's least id goes on.
2. MinHash minima give band keys (from full minima) and a packed signature (the low
   bits of each minimum). Documents with a common band key are candidates.
3. In each bucket, everyone is compared with the least and the greatest id only. The
   similarity is estimated from the equal signature fields, counted in bits and
   corrected for chance collisions; what isn't clearly below the threshold is
   confirmed on the full sets. Confirmed links give components.
4. In buckets that still hold several components, those with a likely partner in
   another component (all, in a bucket of more than ``PAIRED`` members) are compared
   across components: by a common shingle among their rarest ones (prefix filter), by
   a finer b-bit estimate, and on full sets. So every candidate pair is either
   confirmed, refuted, or inside one component already; groups of copies are never
   expanded into all pairs, and the comparisons by signature grow with the members.

With 16 bands of 4 minima a pair of similarity 0.85 has no common bucket with
probability 7e-6, and one of 0.8 with 2e-4.

Defined cases: null, empty and wordless texts have an empty set and link with
nothing; a text with fewer words than a shingle is one shingle, its whole word
sequence; rows with equal ids and different texts count as one document of the
union of their links (``n_shingles`` is the largest), and repeated rows give one
row; null ids are dropped; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import U64, Block, Words, blocks, grams, mix, powers, ragged, signed, words
from foliant.llm.shared import components, cut, hot_keys, salted, small_batches

MINIMA, ROWS, BITS = 64, 4, 4
#: Minima of the finer signature that only documents in doubt get.
FINE = 1024
WORDS_PER_SHINGLE = 5
#: Standard errors below the threshold at which an estimate refutes a pair.
SLACK = 4.5
#: Members of a mixed bucket up to which each is compared with the others by signature; those of larger ones go on to the prefix filter at once.
PAIRED = 64


def shingle_hashes(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a block's texts, not yet distinct, and each text's range."""
    w = words(block)
    values, valid = grams(w, k)
    n = np.diff(w.bounds)
    short = np.flatnonzero((n > 0) & (n < k))
    keep = valid.copy()
    keep[w.bounds[short]] = True
    if len(short):
        values = values.copy()
        values[w.bounds[short]] = [_whole(w, i) for i in short]
    count = np.append(0, np.cumsum(keep))[w.bounds]
    return values[keep], count


def _whole(w: Words, i: int) -> np.uint64:
    h = w.of(i)
    return mix(np.array([np.sum(h * powers(2 * len(h) + 2)[2 : 2 * len(h) + 1 : 2]) + U64(len(h))]))[0]


def distinct_shingles(block: Block, k: int) -> Iterator[np.ndarray]:
    """Each text's set as a sorted array."""
    values, bounds = shingle_hashes(block, k)
    for i in range(len(block)):
        yield np.unique(values[bounds[i] : bounds[i + 1]])


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minima(sets: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """MinHash minima (documents x n) of non-empty sets that lie one after the other."""
    x = (sets >> U64(32)).astype(np.uint32)
    a, b = _multipliers(n)
    out = np.empty((len(starts), n), np.uint32)
    for j in range(n):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], starts)
    return out


def pack_bits(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each minimum, packed into 64-bit words (documents x words)."""
    per = 64 // bits
    low = (low & np.uint32((1 << bits) - 1)).astype(U64).reshape(len(low), -1, per)
    return (low << (np.arange(per, dtype=U64) * U64(bits))).sum(axis=2, dtype=U64)


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int, n_minima: int = MINIMA, rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """(id, n, f1, f2, bands, sig): set size, fingerprint of the set, band keys, packed signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                sets = list(distinct_shingles(block, k))
                n = np.array([len(s) for s in sets])
                flat = np.concatenate(sets)
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                f = np.zeros((2, len(sets)), U64)
                bands, sig = np.zeros((len(full), n_minima // rows), U64), np.zeros((len(full), n_minima * bits // 64), U64)
                if len(full):
                    for i in range(2):
                        f[i, full] = np.add.reduceat(mix(flat ^ U64(0x51_7C_C1_B7_27_22_0A_95 * (i + 1) & 0xFFFFFFFFFFFFFFFF)), starts)
                    low = minima(flat, starts, n_minima)
                    parts = low.astype(U64).reshape(len(full), -1, rows)
                    bands = mix((parts * powers(2 * rows + 2)[1 : 2 * rows : 2]).sum(axis=2, dtype=U64) + np.arange(n_minima // rows, dtype=U64) * U64(0x9E3779B97F4A7C15))
                    sig = pack_bits(low, bits)
                width = lambda m: np.append(0, np.cumsum(np.where(n > 0, m.shape[1], 0)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(block)), pa.array(n), pa.array(signed(f[0])), pa.array(signed(f[1])), ragged(pa.array(signed(bands.ravel())), width(bands)), ragged(pa.array(signed(sig.ravel())), width(sig))],
                    ["id", "n", "f1", "f2", "bands", "sig"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    return source.mapInArrow(run, "id long, n long, f1 long, f2 long, bands array<long>, sig array<long>")


def equal_fields(a: Column, b: Column, n_words: int, bits: int) -> Column:
    """Signature fields that two packed signatures have in common, by bit counts."""
    mask = sum(1 << i for i in range(0, 64, bits))
    mask = F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)
    total = F.lit(0)
    for i in range(n_words):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        folded = x
        for s in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        total = total + F.lit(64 // bits) - F.bit_count(folded.bitwiseAND(mask))
    return total


def estimate(a: Column, b: Column, n_minima: int = MINIMA, bits: int = BITS) -> Column:
    """Jaccard similarity by b-bit MinHash: the share of equal fields, less chance collisions."""
    chance = 2.0**-bits
    return (equal_fields(a, b, n_minima * bits // 64, bits) / F.lit(float(n_minima)) - chance) / (1 - chance)


def _least_estimate(percent: int, n_minima: int, bits: int) -> float:
    chance, j = 2.0**-bits, percent / 100
    p = chance + (1 - chance) * j
    return j - SLACK * (p * (1 - p) / n_minima) ** 0.5 / (1 - chance)


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the stored pairs (a, b), those with 100 * intersection >= percent * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = [s for block in blocks(batch.column(2)) for s in distinct_shingles(block, k)]
            b_text, known = batch.column(3), {}
            keep = []
            for i, left in enumerate(a):
                key = batch.column(1)[i].as_py()
                if key not in known:
                    known = {key: next(distinct_shingles(next(blocks(b_text.slice(i, 1))), k))}
                right = known[key]
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(docs.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    # all copies of a group are paired with its least document: its rows are dealt over several parts
    both = salted(left, "b", "a", docs.select(F.col("id").alias("rep"), F.col("text").alias("tb")), "rep", hot_keys(pairs.groupBy("b").agg(F.count("*").alias("n")), "b", "n"))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def fine_estimate(a: str, b: str) -> Column:
    """``estimate`` for the finer signature, word by word."""
    low = sum(1 << i for i in range(0, 64, BITS))

    def equal(x: Column, y: Column) -> Column:
        x = folded = x.bitwiseXOR(y)
        for i in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, i))
        return F.lit(64 // BITS) - F.bit_count(folded.bitwiseAND(F.lit(low)))

    total = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda t, n: t + n)
    return (total / F.lit(float(FINE)) - 2.0**-BITS) / (1 - 2.0**-BITS)


def _prefix_pairs(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among ``rows (id, c)`` that share a shingle of their prefixes and may be similar enough.

    A set's prefix is its ``n - ceil(percent * n / 100) + 1`` rarest shingles; two sets that are
    similar enough share one of them. Shingles that only one row has take their places in
    the prefix but can't be shared, and they bound the intersection: it is at most the rest
    of either set. Every different text of an id is a set of its own. So near copies that differ by edits of their own drop out here instead of
    being paired with all others of their group.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                sets = [x if len(x) else np.zeros(1, U64) for x in distinct_shingles(block, k)]
                at = np.append(0, np.cumsum([len(x) for x in sets]))
                fine = pack_bits(minima(np.concatenate(sets), at[:-1], FINE), BITS)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), ragged(pa.array(signed(np.concatenate(sets))), at), ragged(pa.array(signed(fine.ravel())), np.arange(len(sets) + 1) * fine.shape[1])], ["id", "h", "fine"])

    of = rows.join(texts, "id").where("text <> ''").dropDuplicates(["id", "text"]).select("id", "text").mapInArrow(shingles, "id long, h array<long>, fine array<long>")
    of = cut(of.withColumn("set", F.monotonically_increasing_id()))
    each = of.select("set", F.explode("h").alias("h"))
    shared = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    ranked = each.join(shared, "h").groupBy("set").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("r"))
    own = ranked.join(of.select("set", "id", "fine", F.size("h").alias("n")), "set").join(rows, "id")
    room = F.size("r") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = cut(own.where(room > 0).select("id", "c", "n", "fine", F.size("r").alias("many"), F.explode(F.slice("r", 1, room.cast("int"))).alias("r")).select("id", "c", "n", "fine", "many", F.col("r.h").alias("h")))
    mixed = prefix.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("h")
    prefix = prefix.join(mixed, "h")
    s, t = prefix.alias("s"), prefix.alias("t")
    both = F.least("s.many", "t.many")
    possible = 100 * both >= percent * (F.col("s.n") + F.col("t.n") - both)
    pairs = s.join(t, (F.col("s.h") == F.col("t.h")) & (F.col("s.id") > F.col("t.id")) & (F.col("s.c") != F.col("t.c")) & possible & (fine_estimate("s.fine", "t.fine") >= _least_estimate(percent, FINE, BITS)))
    return pairs.select(F.col("s.id").alias("a"), F.col("t.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, words_per_shingle: int = WORDS_PER_SHINGLE, paired: int = PAIRED) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, and n_links (confirmed links of its class).

    Documents are linked if 100 * intersection >= percent * union of their shingle sets.
    ``component_id`` is the least id reachable by links, ``kept`` whether that is the document
    itself. ``n_links`` counts the confirmed links between its class of equal sets and other classes.
    """
    small_batches(docs)
    k = words_per_shingle
    sketch = cut(sketches(docs, id_col, text_col, k))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    full = sketch.where("n > 0")
    classes = full.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"))
    member = cut(full.select("id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("id", "n", "rep"))
    same = member.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    # a document whose id is the least of its class stands for it
    stands = full.join(member.where("id = rep").select("id", "n").distinct(), ["id", "n"], "left_semi").dropDuplicates(["id", "f1"])
    sig = stands.select("id", "n", "sig")
    bucket = stands.select("id", F.explode("bands").alias("key"))
    ends = bucket.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    crowded = cut(bucket.join(ends, "key"))
    pairs = crowded.select(F.col("id").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = _least_estimate(percent, MINIMA, BITS)
    likely = lambda x, y: (F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent) & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent) & (estimate(F.col(f"{x}.sig"), F.col(f"{y}.sig")) >= least)
    pairs = pairs.join(sig.select(F.col("id").alias("a"), F.struct("n", "sig").alias("x")), "a").join(sig.select(F.col("id").alias("b"), F.struct("n", "sig").alias("y")), "b")
    checked = cut(pairs.where(likely("x", "y")).select("a", "b"))
    links = cut(_confirmed(checked, texts, k, percent))
    group = cut(components(links))
    # buckets with several components: who has a likely partner in another component?
    placed = crowded.select("key", "id").join(group, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    open_ = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("members")).where("low <> high").select("key", "members")
    rest = cut(placed.join(open_, "key").join(sig, "id"))
    few = rest.where(F.col("members") <= paired)
    s, t = few.alias("s"), few.alias("t")
    other = (F.col("s.key") == F.col("t.key")) & (F.col("s.c") != F.col("t.c")) & likely("s", "t")
    doubtful = cut(s.join(t, other, "left_semi").select("id", "c").unionAll(rest.where(F.col("members") > paired).select("id", "c")).distinct())
    more = _prefix_pairs(doubtful, texts, k, percent).join(checked, ["a", "b"], "left_anti")
    found = cut(_confirmed(cut(more), texts, k, percent))
    links = links.unionAll(found)
    group = components(links.unionAll(same))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    out = sketch.groupBy("id").agg(F.max("n").alias("n_shingles")).join(group, "id", "left")
    out = out.join(member.groupBy("id").agg(F.min("rep").alias("rep")).join(degree, "rep", "left").select("id", "n_links"), "id", "left")
    c = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", c.alias("component_id"), (c == F.col("id")).alias("kept"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Drop every document but the least id of each group of near-duplicates; all columns stay.

    Rows whose id is null are kept as they are; of rows that repeat an id, all stay.
    """
    away = near_duplicates(docs, id_col, text_col, percent).where("not kept").select(F.col(id_col).alias("__gone"))
    return docs.join(away, docs[id_col].cast("long") == away["__gone"], "left_anti")
