"""Search by meaning: the rows whose vectors are nearest to a query's, by cosine.

``exact`` compares every query with every row, block by block. ``build`` stores an
index: k-means on a bounded sample of unit vectors gives cells, and every row is in
the list of its nearest one; a search reads the lists of the cells nearest to a query. How many
it takes is measured: a bounded sample of rows is compared with all, and the least number of cells that
holds ``RECALL`` of the true neighbours is stored with the index (``tune``); where vectors have no
clusters that is most of them, and the index says so by that number.
Lists of heavy cells are dealt over parts, and so are the queries of a cell, so a task
compares ``BLOCK`` rows with ``QUERIES`` queries at most, whatever the sizes. Each comparison keeps
its best ``k`` only; ranking merges these.

Similarities are rounded to ``DIGITS`` places before they are ranked, ties by the
lesser id, so equal vectors stand in the order of their ids wherever they are compared.
A row isn't its own neighbour. Vectors that are null, of another length, without
direction or with missing or infinite numbers, and rows without id, are in the index but near to nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators.store import new_path, read_text, write_text

BLOCK, QUERIES, DIGITS = 16_384, 2048, 9
#: Rows of an Arrow batch at most where queries are repeated for each of their cells.
REPEATED = 16_384
#: Cells at most, rows of the sample per cell, and bytes of all centres at most (they go to every task).
MOST_CELLS, SAMPLE_PER_CELL, CENTRE_BYTES = 4096, 32, 64 << 20
#: Rows that ``tune`` asks for, and the share of their true neighbours that the cells it chooses hold.
TUNED_ON, RECALL = 256, 0.96
#: The cell of vectors that are near to nothing.
NOWHERE = -1
FOUND = "query long, id long, similarity double"


def unit(vector: Column, dims: int) -> Column:
    """The vector with length 1 as doubles; null where it has no direction or another length."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    fine = (F.size(vector) == dims) & (norm > 0) & (norm < math.inf)
    return F.when(fine, F.transform(v, lambda x: x / norm))


def _rows(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.when(F.col(id_col).isNotNull(), unit(F.col(vector_col), dims)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) if len(flat) else np.zeros((0, dims))


def nearest(queries: pa.Table, rows: pa.Table, dims: int, k: int) -> pa.Table:
    """The best ``k`` of ``rows (id, v)`` for each of ``queries (query, q)``."""
    ids = rows.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], _matrix(rows.column("v"), dims)[order]
    asked, q = queries.column("query").to_numpy(), _matrix(queries.column("q"), dims)
    out = []
    for a in range(0, len(asked), 128):
        near = np.round(q[a : a + 128] @ v.T, DIGITS)
        for i, s in enumerate(near):
            s = np.where(ids == asked[a + i], -np.inf, s)
            some = np.flatnonzero(s >= np.partition(s, -k)[-k]) if len(s) > k else np.arange(len(s))
            best = some[np.argsort(-s[some], kind="stable")[:k]]  # ids ascend
            best = best[s[best] > -np.inf]
            out.append((np.full(len(best), asked[a + i]), ids[best], s[best]))
    parts = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(parts, ["query", "id", "similarity"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """(query, rank, id, similarity): the best ``k`` of each query's candidates, rank from 1."""
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "similarity")


def _compare(rows: DataFrame, queries: DataFrame, by: list[str], dims: int, k: int) -> DataFrame:
    pairs = queries.groupBy(*by).cogroup(rows.groupBy(*by))
    return _ranked(pairs.applyInArrow(lambda q, r: nearest(q, r, dims, k), FOUND), k)


def _deal(by: str, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def exact(vectors: DataFrame, queries: DataFrame, dims: int, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, rank, id, similarity): the ``k`` nearest rows of each query, by comparing all.

    Rows and queries are dealt into blocks, and every pair of blocks is one comparison:
    the work is rows times queries, in memory bounded by the blocks.
    """
    return _against_all(_rows(vectors, id_col, vector_col, dims).dropna(), _rows(queries, id_col, vector_col, dims).dropna(), dims, k)


def _against_all(rows: DataFrame, asked: DataFrame, dims: int, k: int) -> DataFrame:
    blocks, lots = (max(1, -(-df.count() // size)) for df, size in ((rows, BLOCK), (asked, QUERIES)))
    rows = rows.select("id", "v", _deal("id", blocks).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("l"))
    asked = asked.select(F.col("id").alias("query"), F.col("v").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), _deal("id", lots).alias("l"))
    return _compare(rows, asked, ["b", "l"], dims, k)


@dataclass
class Index:
    """Stored lists ``(cell, id, v)``, the cells' centres (a row per cell) and how many cells a search reads by default."""

    path: str
    centres: np.ndarray
    lists: DataFrame
    probes: int

    @property
    def dims(self) -> int:
        return self.centres.shape[1]


def _close(batches: Iterator[pa.RecordBatch], centres: np.ndarray, probes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, v) once for each of their ``probes`` nearest cells, ``REPEATED`` rows a batch at most, however many cells there are."""
    dims, step = centres.shape[1], max(1, min(1024, REPEATED // probes))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            close = _matrix(part.column(1), dims) @ centres.T
            cell = np.argpartition(-close, probes - 1, axis=1)[:, :probes] if probes < len(centres) else np.tile(np.arange(len(centres)), (len(close), 1))
            again = pa.array(np.repeat(np.arange(part.num_rows), probes))
            yield pa.RecordBatch.from_arrays([part.column(0).take(again), part.column(1).take(again), pa.array(cell.ravel().astype(np.int32))], ["id", "v", "cell"])


def _assign(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """``rows (id, v)`` once for each of their ``probes`` nearest cells; (id, v, cell), v null and cell ``NOWHERE`` for those without direction."""
    shared, probes = rows.sparkSession.sparkContext.broadcast(centres), min(probes, len(centres))
    placed = rows.where("v is not null").mapInArrow(lambda batches: _close(batches, shared.value, probes), "id long, v array<double>, cell int")
    return placed.unionByName(rows.where("v is null").select("id", "v", F.lit(NOWHERE).alias("cell")))


def train(vectors: DataFrame, dims: int, cells: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7) -> np.ndarray:
    """Centres by k-means under cosine on ``SAMPLE_PER_CELL`` rows per cell, chosen by a hash of the id; as many cells as the root of the rows by default."""
    rows = _rows(vectors, id_col, vector_col, dims).dropna()
    cells = cells or min(MOST_CELLS, max(1, round(math.sqrt(rows.count()))))
    if cells * dims * 8 > CENTRE_BYTES:
        raise ValueError("the centres would take more than CENTRE_BYTES; use fewer cells")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CELL * cells).select(array_to_vector("v").alias("features"))
    sample = sample.repartition(rows.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        if sample.count() <= 1:
            return np.full((1, dims), 1 / math.sqrt(dims))
        found = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=10).fit(sample).clusterCenters()
    finally:
        sample.unpersist()
    return np.array(found)


def build(vectors: DataFrame, dims: int, path: str | None = None, cells: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """Fit cells to a sample and store every row in the list of its nearest one, sorted by cell, so a search skips files and row groups of other cells."""
    spark = vectors.sparkSession
    path = path or new_path(spark, "vectors")
    centres = train(vectors, dims, cells, id_col, vector_col)
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/cells")
    _store(_assign(_rows(vectors, id_col, vector_col, dims), centres, 1), path)
    return tune(load(spark, path))


def tune(index: Index, k: int = 10, recall: float = RECALL, sample: int = TUNED_ON) -> Index:
    """Measure and store the least number of cells that holds ``recall`` of the ``k`` true neighbours of ``sample`` rows, chosen by a hash of the id."""
    spark, rows = index.lists.sparkSession, index.lists.where("v is not null")
    asked = rows.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample).select("id", "v")
    true = _against_all(rows.select("id", "v"), asked, index.dims, k)
    cells = true.join(rows.select("id", "cell"), "id").join(asked.select(F.col("id").alias("query"), F.col("v").alias("q")), "query").select("q", "cell")
    found = cells.collect()  # sample * k rows at most
    if found:
        close = np.array([r["q"] for r in found]) @ index.centres.T
        own = close[np.arange(len(found)), [r["cell"] for r in found]]
        rank = np.sort((close > own[:, None]).sum(1))
        probes = int(rank[min(len(rank) - 1, math.ceil(recall * len(rank)) - 1)]) + 1
    else:
        probes = 1
    write_text(spark, f"{index.path}/probes", str(probes))
    return load(spark, index.path)


def _store(placed: DataFrame, path: str) -> None:
    placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.mode("append").parquet(f"{path}/lists")


def add(index: Index, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """Rows appended to the lists of the cells as they are; ids that are there already must not come again."""
    _store(_assign(_rows(vectors, id_col, vector_col, index.dims), index.centres, 1), index.path)
    return load(vectors.sparkSession, index.path)


def load(spark: SparkSession, path: str) -> Index:
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MOST_CELLS rows at most
    lists = spark.read.schema("id long, v array<double>, cell int").parquet(f"{path}/lists")
    return Index(path, np.array([r["centre"] for r in cells]), lists, int(read_text(spark, f"{path}/probes") or len(cells)))


def search(index: Index, queries: DataFrame, k: int = 10, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, rank, id, similarity): the ``k`` nearest rows in the ``probes`` cells nearest to each query (by default as many as ``tune`` found)."""
    asked = _assign(_rows(queries, id_col, vector_col, index.dims).dropna(), index.centres, probes or index.probes).where("v is not null")
    asked = asked.select(F.col("id").alias("query"), F.col("v").alias("q"), "cell")
    # two tables of a row per cell, MOST_CELLS at most
    parts = index.lists.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    lots = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("lots"))
    sizes = F.broadcast(parts.join(lots, "cell"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = index.lists.join(sizes, "cell").select("cell", _deal("id", F.col("parts")).alias("part"), upto("lots").alias("lot"), "id", "v")
    asked = asked.join(sizes, "cell").select("cell", upto("parts").alias("part"), _deal("query", F.col("lots")).alias("lot"), "query", "q")
    return _compare(rows, asked, ["cell", "part", "lot"], index.dims, k)
