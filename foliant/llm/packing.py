"""Operator 7: packing by power-of-two decomposition.

Each document is cut into pieces whose lengths are powers of two, the longest
first: as many pieces of the longest length as fit, then the binary digits of
the rest. Every piece is a sequence of its own and goes to the bucket of its
length, so no sequence crosses documents, none needs padding, and a batch drawn
from one bucket has equal lengths. No shuffle and no global order are needed.

Defined cases: a null or empty text is its end id alone (one piece of length 1);
repeated rows are packed as often as they occur; a null doc_id stays null; an
empty table gives no pieces; further columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import blocks, ragged
from foliant.llm.encode import END_ID, default_tokenizer, ids_array, pieces_of
from foliant.llm.shared import small_batches


def decompose(length: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece (document's index, start, length) of documents of ``length`` ids, in order of index and start."""
    whole, rest = length // longest, length % longest
    bits = [b for b in range(longest.bit_length() - 2, -1, -1)]
    doc = [np.repeat(np.arange(len(length)), whole)]
    start = [(np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)) * longest]
    size = [np.full(int(whole.sum()), longest)]
    done = whole * longest
    for b in bits:
        has = np.flatnonzero(rest >> b & 1)
        doc.append(has)
        start.append(done[has].copy())
        size.append(np.full(len(has), 1 << b))
        done[has] += 1 << b
    doc, start, size = (np.concatenate(x) for x in (doc, start, size))
    order = np.lexsort((start, doc))
    return doc[order], start[order], size[order]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, and ``ids`` unless ``with_ids`` is off.

    ``max_tokens`` must be a power of two. ``bucket`` is the piece's length as a power of
    two; write with ``partitionBy("bucket")`` to get the buckets as folders. ``sequence_id``
    is unique; it comes from the input's partitions, which are the same on recomputation.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    small_batches(docs)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                flat, bounds = pieces_of(block, path, end_id)
                length = np.diff(bounds)
                doc, start, size = decompose(length, max_tokens)
                at = bounds[doc] + start
                raw = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                columns = [batch.column(0).slice(block.first, len(block)).take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(length[doc]), pa.array(np.log2(size).astype(np.int32))]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "bucket"]
                if with_ids:  # pieces lie one after the other in flat
                    columns.append(ragged(ids_array(flat), np.append(at, len(flat))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int" + ", ids array<int>" * with_ids
    out = source.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "bucket", *["ids"] * with_ids)
