"""Tables between steps: written to the folder that driver and executors share, so a lost executor costs no earlier step."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None
#: A key with more rows than this is dealt over parts before a join.
HOT_ROWS = 10_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a new local folder where that is unset and all is one machine (tests)."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = _own = _own or "file://" + tempfile.mkdtemp(prefix="foliant-")
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and renamed, so a reader sees the old one or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p, side = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = p.getFileSystem(conf)
    out = fs.create(side, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(side, p):
        raise OSError(f"can't rename to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


#: Spark's own setting to delete the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go with the end of its job: nothing reads them again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a table and read it back; ``cut_path`` of the result is its folder."""
    path = new_path(df.sparkSession, name)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(df: DataFrame) -> None:
    delete(df.sparkSession, df.cut_path)


#: Rows of an Arrow batch at most where texts or what is made of them go to Python.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_ROWS``; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def dealt(rows: DataFrame, key: str, by: str, other: DataFrame, count: str | None = None, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other``, which has one row per ``key``, where a few keys may have most of the rows.

    Keys of more than ``HOT_ROWS`` rows are dealt over parts of about that many by a hash of ``by``,
    and the other side's row of such a key is repeated once per part. ``count`` names the column of
    ``other`` that holds a key's rows, if it has one; without it they are counted. A ``left`` join keeps
    the rows whose key ``other`` doesn't have.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("__n")) if count is None else other.select(key, F.col(count).alias("__n"))
    hot = sizes.where(F.col("__n") > HOT_ROWS)  # one key in HOT_ROWS rows at most
    hot = F.broadcast(hot.select(key, F.ceil(F.col("__n") / HOT_ROWS).cast("int").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1))
    left = rows.join(hot, key, "left").withColumn("__part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__parts")
    right = other.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return left.join(right, [key, "__part"], how).drop("__part")
