"""Operator 1: exact length histogram.

Documents are encoded whole and counted by their number of ids. Suffix sums over
the histogram then answer, for every context limit, how many documents are
longer, how many ids a truncation keeps, and every exact quantile. The histogram
has at most one row per distinct length; its suffix sums are made in two levels
(groups of lengths, then lengths within a group), so no window sees it whole.

Defined cases: a null or empty text has length 0; repeated rows count each time;
an empty table gives an empty histogram, whose totals are 0 and quantiles null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm._arrow import blocks
from foliant.llm.encode import default_tokenizer, encoder
from foliant.llm.shared import cut, small_batches

GROUP = 1024


def lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Partial histogram (n_tokens, n_docs): a row per length and block of texts."""
    small_batches(docs)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                value, n = np.unique(encoder(path).lengths(block), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["n_tokens", "n_docs"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n_tokens long, n_docs long")


def histogram(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per distinct length, with suffix sums.

    ``n_docs`` documents have ``n_tokens`` ids; ``docs_longer`` have more and hold
    ``tokens_longer``; ``docs_up_to`` have as many or fewer; ``kept_at_limit`` ids are kept
    if every document is cut at this length, and ``lost_at_limit`` are cut off;
    ``quantile_from < q <= quantile_to`` holds for the quantiles q that are this length.
    """
    # a row per distinct length, used twice below: encode once
    counts = cut(lengths(docs, text_col, tokenizer).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")))
    counts = counts.withColumn("part", F.floor(F.col("n_tokens") / GROUP)).withColumn("ids", F.col("n_tokens") * F.col("n_docs"))
    parts = counts.groupBy("part").agg(F.sum("n_docs").alias("pd"), F.sum("ids").alias("pt"))
    after = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    parts = parts.select("part", F.coalesce(F.sum("pd").over(after), F.lit(0)).alias("da"), F.coalesce(F.sum("pt").over(after), F.lit(0)).alias("ta"), F.sum("pd").over(every).alias("docs"), F.sum("pt").over(every).alias("tokens"))
    inner = Window.partitionBy("part").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.join(parts, "part").select(
        "n_tokens", "n_docs", "docs", "tokens",
        (F.col("da") + F.coalesce(F.sum("n_docs").over(inner), F.lit(0))).alias("docs_longer"),
        (F.col("ta") + F.coalesce(F.sum("ids").over(inner), F.lit(0))).alias("tokens_longer"),
    )
    kept = F.col("tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")
    up_to = F.col("docs") - F.col("docs_longer")
    return out.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer", up_to.alias("docs_up_to"), kept.alias("kept_at_limit"), (F.col("tokens") - kept).alias("lost_at_limit"),
        ((up_to - F.col("n_docs")) / F.col("docs")).alias("quantile_from"), (up_to / F.col("docs")).alias("quantile_to"),
    )


def limits(hist: DataFrame, context: list[int]) -> DataFrame:
    """For each context limit: documents longer, ids kept by truncation, ids lost."""
    total = [F.coalesce(F.sum(F.when(F.col("n_tokens") > c, F.col("n_docs"))), F.lit(0)).alias(f"d{c}") for c in context]
    kept = [F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(c)) * F.col("n_docs")), F.lit(0)).alias(f"k{c}") for c in context]
    tokens = F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("t")
    rows = F.explode(F.array(*[F.struct(F.lit(c).cast("long").alias("context"), F.col(f"d{c}").alias("docs_longer"), F.col(f"k{c}").alias("tokens_kept"), (F.col("t") - F.col(f"k{c}")).alias("tokens_lost")) for c in context]))
    return hist.agg(*total, *kept, tokens).select(rows.alias("r")).select("r.*")


def quantiles(hist: DataFrame, q: list[float]) -> DataFrame:
    """Exact quantiles: the least length that at least a share ``q`` of the documents doesn't exceed."""
    got = [F.min(F.when(F.col("quantile_to") >= x, F.col("n_tokens"))).alias(f"q{i}") for i, x in enumerate(q)]
    return hist.agg(*got).select(F.explode(F.array(*[F.struct(F.lit(x).alias("q"), F.col(f"q{i}").alias("n_tokens")) for i, x in enumerate(q)])).alias("r")).select("r.*")
