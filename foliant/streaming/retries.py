"""A log of attempts as a stream: what each document's latest outcome is, when to try again, and what is forgotten.

State per id (``transformWithState``): latest outcome by (time, number), how many attempts there were,
and two event-time timers: one for the next try of what failed, after a pause that doubles with each
attempt, one that forgets an id nothing is heard of for ``keep``. Lines may come late, within
the watermark's delay: the latest outcome is the one with the latest time, in whatever order
lines come. Every batch writes its rows to a folder of its number, so a batch that is run again
after a failure replaces what it wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from foliant.streaming.incremental import ROCKS, STATE_STORE

STATE, DUE, FORGOTTEN = "state", "due", "forgotten"
#: Seconds before the second attempt, and how often that doubles at most.
PAUSE, DOUBLINGS = 3600, 6
OUTPUT = "id long, kind string, outcome string, at timestamp, tries long, next_try timestamp"


def next_try(at: F.Column, tries: F.Column, pause: int = PAUSE) -> F.Column:
    """When what failed at ``at`` for the ``tries``-th time is tried again."""
    return F.timestamp_micros(F.unix_micros(at) + (F.pow(F.lit(2), F.least(tries, F.lit(DOUBLINGS)) - 1) * pause * 1_000_000).cast("long"))


class Attempts(StatefulProcessor):
    """Rows (id, outcome, at microseconds, seq) to ``OUTPUT``, times in microseconds since 1970."""

    def __init__(self, ok: list[str], pause: int = PAUSE, keep: int | None = None):
        self.ok, self.pause, self.keep = frozenset(ok), pause, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempts", "at long, seq long, outcome string, tries long, next long, forget long")

    def _row(self, key: tuple, kind: str, at: int, outcome: str, tries: int, after: int) -> Row:
        return Row(id=key[0], kind=kind, outcome=outcome, at=at, tries=tries, next_try=after or None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        # each call is a message to the engine: one tells both whether there is a state and what it is
        at, seq, outcome, tries, due, forget = self.state.get() or (-(1 << 62), -(1 << 62), None, 0, 0, 0)
        for r in rows:
            tries += 1
            if (r.at, r.seq) >= (at, seq):
                at, seq, outcome = r.at, r.seq, r.outcome
        now = timerValues.getCurrentWatermarkInMs()
        after = 0 if outcome in self.ok else at + 2 ** (min(tries, DOUBLINGS) - 1) * self.pause * 1_000_000
        gone = at + self.keep * 1_000_000 if self.keep else 0
        for old, new in ((due, after), (forget, gone)):
            if old and old != new and old // 1000 + 1 > now:
                self.handle.deleteTimer(old // 1000 + 1)
            if new and new // 1000 + 1 > now:
                self.handle.registerTimer(new // 1000 + 1)
        self.state.update((at, seq, outcome, tries, after, gone))
        yield self._row(key, STATE, at, outcome, tries, after)
        if after and after // 1000 + 1 <= now and after != due:
            yield self._row(key, DUE, at, outcome, tries, after)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.state.exists():
            return
        at, _, outcome, tries, due, forget = self.state.get()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if due and fired == due // 1000 + 1:
            yield self._row(key, DUE, at, outcome, tries, due)
        if forget and fired == forget // 1000 + 1:
            self.state.clear()
            yield self._row(key, FORGOTTEN, at, outcome, tries, due)

    def close(self) -> None:
        pass


def attempts(log: DataFrame, ok: list[str], delay: str, pause: int = PAUSE, keep: int | None = None) -> DataFrame:
    """``OUTPUT`` rows of a streaming ``log (id, outcome, at timestamp, seq)``; lines later than ``delay`` behind the latest time are dropped."""
    marked = log.withWatermark("at", delay).select("id", "outcome", F.col("at").alias("__event"), F.unix_micros("at").alias("at"), "seq")
    wire = OUTPUT.replace("timestamp", "long")
    found = marked.groupBy("id").transformWithState(Attempts(ok, pause, keep), wire, "Update", "EventTime")
    return found.select("id", "kind", "outcome", F.timestamp_micros("at").alias("at"), "tries", F.timestamp_micros("next_try").alias("next_try"))


def run(spark: SparkSession, source: str, schema, read: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, ok: list[str], delay: str, pause: int = PAUSE, keep: int | None = None, files: int = 1) -> None:
    """Process what has come to ``source`` since the last run, ``files`` files a batch, and stop; ``read`` makes (id, outcome, at, seq) of it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        log = read(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source))
        stream = attempts(log, ok, delay, pause, keep).writeStream.outputMode("update").foreachBatch(write)
        stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)


def told(spark: SparkSession, target: str) -> DataFrame:
    """All rows that the batches wrote, with their batch."""
    return spark.read.schema(f"{OUTPUT}, batch int").parquet(target)


def latest(spark: SparkSession, target: str) -> DataFrame:
    """(id, outcome, at, tries, next_try): the state of every id that isn't forgotten."""
    order = F.struct("batch", (F.col("kind") == FORGOTTEN).cast("int"), "tries")
    last = told(spark, target).where(F.col("kind") != DUE).groupBy("id").agg(F.max_by(F.struct("kind", "outcome", "at", "tries", "next_try"), order).alias("s"))
    return last.where(F.col("s.kind") == STATE).select("id", "s.outcome", "s.at", "s.tries", "s.next_try")


def to_try(spark: SparkSession, target: str, now: dt.datetime) -> DataFrame:
    """Ids whose next try is due at ``now``."""
    return latest(spark, target).where(F.col("next_try") <= F.lit(now))
