"""Counters of a run, taken while it runs: no second pass over the data, batch and stream alike."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from foliant.operators.store import cut

AUDIT = "step string, batch long, counter string, value long"


def counted(df: DataFrame, step: str, write: Callable[[DataFrame], None], **counters: Column) -> DataFrame:
    """Audit rows (``AUDIT``) of one step: ``write`` runs once, and the counters, aggregates over what it wrote, come with it.

    ``rows`` is always among them. A counter is a condition (rows that meet it) or any aggregate of type long.
    """
    seen = Observation(step)
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()]))
    got = seen.get
    return df.sparkSession.createDataFrame([(step, None, n, int(v or 0)) for n, v in got.items()], AUDIT)


def cut_counted(df: DataFrame, step: str, **counters: Column) -> tuple[DataFrame, DataFrame]:
    """(the table, written and read back, and its audit rows) of a step."""
    made = []
    audit = counted(df, step, lambda d: made.append(cut(d, step)), **counters)
    return made[0], audit


class StreamCounters(StreamingQueryListener):
    """Keeps the observed counters of every batch of the streams that ``watch`` has prepared, while it is registered.

    with StreamCounters(spark) as seen: ...; seen.rows() gives the audit rows of all batches.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.found, self.ended = spark, [], threading.Event()

    def __enter__(self) -> StreamCounters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.ended.wait(10)
        self.spark.streams.removeListener(self)

    @staticmethod
    def watch(df: DataFrame, step: str, **counters: Column) -> DataFrame:
        return df.observe(step, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()])

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended.clear()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for step, row in event.progress.observedMetrics.items():
            self.found += [(step, event.progress.batchId, n, int(v or 0)) for n, v in row.asDict().items()]

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.set()

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame(self.found, AUDIT)
