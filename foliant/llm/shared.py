"""Cutting lineage through the shared folder, and connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None
#: Paths of tables that ``cut`` wrote and nothing has deleted.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a new local one where unset and all is one machine (tests)."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = _own = _own or "file://" + tempfile.mkdtemp(prefix="foliant-")
    return base.rstrip("/")


#: Rows of an Arrow batch at most; texts can be long, and a batch is held whole on both sides.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> SparkSession:
    """Bound the session's Arrow batches by ``BATCH_ROWS`` (a lower setting stays) and return the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df.sparkSession


#: Spark's own setting to delete the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write to a new table in the shared folder and read it back: losing an executor then loses no work.

    The shuffle files behind the table go with the end of its job: nothing reads them again.
    """
    conf = df.sparkSession.conf
    path, before = f"{shared_dir(df.sparkSession)}/foliant-{uuid.uuid4().hex}", conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    _made.append(path)
    return out


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, in the end, all tables that ``cut`` wrote meanwhile: for a step whose result has been written elsewhere by then."""
    known = len(_made)
    try:
        yield
    finally:
        while len(_made) > known:
            delete(spark, _made.pop())


def discard(df: DataFrame) -> None:
    """Delete a table that ``cut`` wrote, once nothing reads it any more, and the shuffle files that only past jobs needed."""
    spark = df.sparkSession
    gc.collect()
    spark._jvm.System.gc()
    delete(spark, df.cut_path)
    if df.cut_path in _made:
        _made.remove(df.cut_path)


#: A key that more rows than this share is dealt over several parts before a join.
HOT_ROWS = 2000


def hot_keys(counted: DataFrame, key: str, n: str) -> DataFrame:
    """(__hot, __parts) of the keys with more than ``HOT_ROWS`` rows, from a table of counts: one in ``HOT_ROWS`` rows at most."""
    return counted.where(F.col(n) > HOT_ROWS).select(F.col(key).alias("__hot"), F.ceil(F.col(n) / HOT_ROWS).cast("int").alias("__parts"))


def salted(rows: DataFrame, key: str, by: str, other: DataFrame, other_key: str, hot: DataFrame) -> DataFrame:
    """``rows`` joined with ``other (other_key, ...)``, where a few keys may have most of the rows.

    The ``hot_keys`` are dealt over as many parts as keep each about ``HOT_ROWS`` rows, by a hash
    of column ``by`` (so that a task that is repeated deals alike), and the other side's rows of
    these keys are repeated once per part.
    """
    parts = F.coalesce("__parts", F.lit(1))
    dealt = rows.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__hot", "__parts")
    again = other.join(hot, F.col(other_key) == F.col("__hot"), "left").withColumn("__p", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__hot", "__parts")
    return dealt.join(again, (F.col(key) == F.col(other_key)) & (F.col("__part") == F.col("__p"))).drop("__part", "__p")


def learns(column: str, folds: int, held: int) -> Column:
    """Whether a row's label may be learned: its fold isn't the held-out one."""
    return ~held_out(column, folds, held)


def held_out(column: str, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == held, F.lit(False))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges (a, b)``: one row (id, component) for each node with an edge.

    Alternates the large-star and small-star steps until the edges no longer change. Each
    step is a ``min`` by node (pre-aggregated before its shuffle) and a join, so a node with
    very many neighbours is never gathered in one place; the number of rounds grows with the
    logarithm of a component's size. ``component`` is the least id of the component.
    Self loops count as nodes; null ids are dropped.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    was = mark(now)
    for _ in range(rounds):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionAll(now.where("a = b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        before, now = now, cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        delete(now.sparkSession, before.cut_path)
        _made.remove(before.cut_path)
        if (mark_now := mark(now)) == was:
            break
        was = mark_now
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionAll(
        now.where("a <> b").groupBy(F.col("b").alias("id")).agg(F.min("b").alias("component"))
    ).groupBy("id").agg(F.min("component").alias("component"))
