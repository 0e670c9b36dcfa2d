"""Incremental processing: new files are compared with what is known, only news are processed, and state survives restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: A state store on disk: keys needn't fit into memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(spark: SparkSession, source: str, schema, checkpoint: str, process: Callable[[DataFrame, int], None], file_format: str = "parquet", only: str | None = None):
    """Process all files that aren't yet, in micro-batches, and stop; the checkpoint says where to go on. ``only``: a glob of file names."""
    reader = spark.readStream.schema(schema).format(file_format)
    stream = (reader.option("pathGlobFilter", only) if only else reader).load(source)
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_new(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str, file_format: str = "parquet", only: str | None = None):
    """Append the rows with unseen keys of all files that aren't processed yet, and stop.

    Which keys have been seen is the stream's state, dealt over the executors by key: a batch looks its own keys
    up and doesn't read what earlier ones wrote. Every batch has a folder of its number, so one that
    is run again replaces what it wrote. Of rows that share a key in one batch any one stays; null is a key like others.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    reader = spark.readStream.schema(schema).format(file_format)
    stream = (reader.option("pathGlobFilter", only) if only else reader).load(source).dropDuplicates([key])
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return query


def appended(spark: SparkSession, schema, target: str) -> DataFrame:
    """What ``append_new`` has written."""
    return spark.read.schema(schema).parquet(target)
