"""Operator 11: how far the sources of a language diverge, by dense blocks of terms.

Terms are counted with Spark's own functions: a text's terms are sorted, so the first
of each run counts for the document frequency and one aggregate per (lang, source,
term), combined before its shuffle, holds both numbers. Kept terms are dealt by a hash
over tiles of at most ``CELLS`` (source, term) pairs. A tile becomes a dense numpy
int64 matrix of sources by terms; broadcasting compares all pairs of its sources in
slices of bounded size, and gives a partial matrix of pairs and, for each source, a heap
of the terms that it uses more than its language does. Partial matrices are summed
and heaps merged by Spark. Languages with very many sources have their pairs cut
into bands too, so no task holds more than some ``CELLS`` numbers of any kind.

All arithmetic is exact: shares are whole numbers of about 1e-9, computed in two
steps that stay within 64 bits up to 2.8e14 occurrences in a language.

Defined cases: null text, lang and source count as empty; a group without terms
still has a row for each other source; a language without kept terms gives value 0
to all its pairs; repeated rows and ids count as rows; a language with one source
has no pairs; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.shared import cut

#: Numbers of a dense matrix, and of a slice of compared pairs, at most.
CELLS = 1 << 20
SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE = 1_000_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "lang string, source string, part string, item string, value long"


def terms(text: Column) -> Column:
    """The terms of a text, in order of the text: runs of letters and of anything beyond ASCII; A-Z count as a-z."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATOR), "")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * (count + 2) / total), exactly: 1e9 = 32000 * 31250, so no product leaves 64 bits."""
    whole, rest = np.divmod((count + 2) * 32_000, total)
    return 1 + whole * 31_250 + rest * 31_250 // total


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents."""
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(read(lang_col).alias("lang"), read(source_col).alias("source"), F.sort_array(terms(read(text_col))).alias("term"))
    rows = rows.select("lang", "source", "term", F.concat(F.array(F.lit(None).cast("string")), "term").alias("before"))
    rows = rows.select("lang", "source", F.inline(F.arrays_zip("term", "before"))).where("term is not null")
    new = (~F.col("term").eqNullSafe(F.col("before"))).cast("long")
    return rows.groupBy("lang", "source", "term").agg(F.count("*").alias("n"), F.sum(new).alias("df"))


def top_terms(value: np.ndarray, rank: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """A heap of the ``top`` greatest values as (-value, rank, position); ties by the lesser rank."""
    if len(value) > top > 0:
        low = np.partition(value, -top)[-top]
        at = np.flatnonzero(value >= low)
    else:
        at = np.arange(len(value))
    return heapq.nsmallest(top, zip((-value[at]).tolist(), rank[at].tolist(), at.tolist(), strict=True))


def tile(terms_in: pa.Table, about: pa.Table, top: int) -> pa.Table:
    """Partial pairs and heaps of one tile; ``about`` is one row (lang, block, band, sources, sums, v, total, first, last)."""
    if not about.num_rows:
        raise ValueError("a tile of a language that isn't known")
    info = about.slice(0, 1).to_pylist()[0]
    lang, names, first, last = info["lang"], pa.array(info["sources"], pa.string()), info["first"], min(info["last"], len(info["sources"]))
    word = terms_in.column("term").combine_chunks()
    cells = terms_in.column("cells").combine_chunks()
    cells = cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells
    word = word.chunk(0) if isinstance(word, pa.ChunkedArray) else word
    flat = cells.flatten()
    row = np.repeat(np.arange(len(word)), np.diff(cells.offsets.to_numpy())) if len(word) else np.zeros(0, np.int64)
    counts = np.zeros((len(names), len(word)), np.int64)
    if len(word):
        counts[pc.index_in(flat.field("source"), names).to_numpy(zero_copy_only=False), row] = flat.field("n").to_numpy(zero_copy_only=False)
    smooth = 2 * info["v"]
    p = share(counts, np.array(info["sums"], np.int64)[:, None] + smooth) if len(word) else counts
    pairs = np.zeros((last - first, len(names)), np.int64)
    wide = max(1, min(len(word), CELLS // max(1, len(names))))
    tall = max(1, CELLS // max(1, len(names) * wide))
    for i in range(first, last, tall):
        j = min(i + tall, last)
        for a in range(0, len(word), wide):
            pairs[i - first : j - first] += distance(p[i:j, None, a : a + wide], p[None, :, a : a + wide]).sum(2)
    a, b = np.nonzero(np.arange(first, last)[:, None] < np.arange(len(names))[None, :])
    out = [(names.take(pa.array(a + first)), names.take(pa.array(b)), pairs[a, b], "pair")]
    if len(word):
        q = share(terms_in.column("total").to_numpy(), np.int64(info["total"] + smooth))
        rank_of = np.empty(len(word), np.int64)
        rank_of[pc.sort_indices(word.cast(pa.binary())).to_numpy()] = np.arange(len(word))
        for i in range(first, last):
            more = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            heap = top_terms(distance(p[i, more], q[more]), rank_of[more], top)
            out.append((pa.repeat(names[i], len(heap)), word.take(pa.array([more[k] for _, _, k in heap], pa.int64())), np.array([-v for v, _, _ in heap], np.int64), "term"))
    tables = [pa.table([pa.repeat(pa.scalar(lang), len(v)), s, pa.repeat(pa.scalar(kind), len(v)), item, pa.array(v, pa.int64())], ["lang", "source", "part", "item", "value"]) for s, item, v, kind in out]
    return pa.concat_tables(tables)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 10, top: int = 10, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): the other sources of each source's language by distance, and its ``top`` telling terms."""
    counts = term_counts(docs, lang_col, source_col, text_col)
    by_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("cells"))
    kept = cut(by_term.where(F.col("df") >= min_docs).drop("df"))  # a term has one cell per source at most

    read = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    groups = docs.select(read(lang_col, "lang"), read(source_col, "source")).distinct()
    sums = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("s"))
    groups = groups.join(sums, ["lang", "source"], "left").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("s", F.lit(0)).alias("s")))).alias("g"))
    langs = groups.join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("total")), "lang", "left")
    width = F.size("g").cast("long")
    langs = cut(langs.select(
        "lang", F.col("g.source").alias("sources"), F.col("g.s").alias("sums"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"),
        F.greatest(F.ceil(F.coalesce("v", F.lit(0)) * width / cells), F.lit(1)).cast("int").alias("blocks"),
        F.greatest(F.lit(cells) / width, F.lit(1)).cast("int").alias("height"),
    ))
    ends = F.sequence(F.lit(0), F.ceil(F.size("sources") / F.col("height")).cast("int") - 1)
    sizes = langs.select("lang", "blocks", F.explode(ends).alias("band"))  # one row per language, but for those of very many sources
    about = langs.withColumn("band", F.explode(ends)).select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "band", "sources", "sums", "v", "total",
        (F.col("band") * F.col("height")).alias("first"), ((F.col("band") + 1) * F.col("height")).alias("last"),
    )
    dealt = kept.join(sizes, "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"), "band", "term", "total", "cells")
    key = ["lang", "block", "band"]
    parts = dealt.groupBy(*key).cogroup(about.groupBy(*key)).applyInArrow(lambda left, right: tile(left, right, top), RESULT)
    parts = cut(parts)

    half = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = half.select("lang", F.explode(both).alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    heaps = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(heaps)


#: The same in DuckDB.
SQL = r"""WITH d AS (SELECT coalesce(lang,'') AS lang, coalesce(source,'') AS source,
    regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
cnt AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gs AS (SELECT g.lang, g.source, coalesce(v.v,0) AS v, coalesce(sum(c.n),0) AS s FROM grp g LEFT JOIN v USING (lang) LEFT JOIN cnt c USING (lang, source) GROUP BY ALL),
ls AS (SELECT lang, any_value(v) AS v, sum(s) AS s FROM gs GROUP BY lang),
p AS (SELECT gs.lang, gs.source, term, coalesce(cnt.n,0) AS n, 1+(1000000000::HUGEINT*(coalesce(cnt.n,0)+2))//(gs.s+2*gs.v)::HUGEINT AS p FROM gs JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)),
q AS (SELECT lang, term, 1+(1000000000::HUGEINT*(sum(n)+2)::HUGEINT)//(any_value(ls.s)+2*any_value(ls.v))::HUGEINT AS q FROM cnt JOIN ls USING (lang) GROUP BY lang, term),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((pa.p-pb.p)*(pa.p-pb.p)//(pa.p+pb.p)),0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang=b.lang AND a.source<>b.source
    LEFT JOIN p pa ON pa.lang=a.lang AND pa.source=a.source LEFT JOIN p pb ON pb.lang=b.lang AND pb.source=b.source AND pb.term=pa.term GROUP BY ALL),
tr AS (SELECT p.lang, p.source, p.term AS item, ((p.p-q.q)*(p.p-q.q)//(p.p+q.q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n>0 AND p.p>q.q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pr
UNION ALL SELECT lang, source, 'term', item, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM tr) WHERE rank <= 10"""
