"""Runs that compare what a source has now with what is known: versions, a cursor that is set last, and summaries that follow.

A run takes a snapshot of a source (one row per key) and compares it with the state of the
run before, by key and content hash: rows are ``new``, ``changed``, ``vanished``, ``back`` again
or the same. Only what isn't the same becomes a version. A run's folders are named by its
number and the cursor, a small file, is replaced when all of them are there: readers see
finished runs only, and a run that stopped on the way is done again under the same number,
over its own remains. A comparison joins the keys and hashes of one state with those
of the snapshot, so it doesn't grow with the number of runs; whole rows are read for versions only.

Summaries are kept as sums by group. A run adds what its versions bring and takes out what
they replace: a card that changes its kind leaves the old kind's numbers.

Defined cases: rows without a key are left out; of rows that repeat a key the one with the
greatest hash counts; nulls are content like any other; an empty snapshot makes all vanish.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.store import delete, exists, read_text, write_text

NEW, CHANGED, VANISHED, BACK = "new", "changed", "vanished", "back"


class Versions:
    """Versions of a source's rows under ``base``, a folder that driver and executors share.

    ``facts`` are small columns that the state carries beside the hash, for summaries over them.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, facts: tuple[str, ...] = ()):
        self.spark, self.base, self.key, self.facts = spark, base.rstrip("/"), key, list(facts)

    def cursor(self) -> dict:
        """The last finished run: {run, source, until, ...}; run 0 before the first."""
        text = read_text(self.spark, f"{self.base}/source_cursor")
        return json.loads(text) if text else {"run": 0}

    def _at(self, kind: str, run: int) -> str:
        return f"{self.base}/{kind}/run={run}"

    def _hashed(self, snapshot: DataFrame) -> DataFrame:
        row = F.to_json(F.struct(*[F.col(c) for c in sorted(snapshot.columns)]), {"ignoreNullFields": "false"})
        rows = snapshot.where(F.col(self.key).isNotNull()).select(F.col(self.key).alias("__key"), F.sha2(row, 256).alias("__hash"), *[F.col(f).alias(f"__{f}") for f in self.facts])
        best = F.max_by(F.struct("__hash", *[f"__{f}" for f in self.facts]), "__hash").alias("__now")
        return rows.groupBy("__key").agg(best)

    def state(self, run: int | None = None) -> DataFrame | None:
        """(__key, __was struct<__hash, facts>, __present) after a run; None before the first."""
        run = self.cursor()["run"] if run is None else run
        return self.spark.read.parquet(self._at("state", run)) if run else None

    def difference(self, snapshot: DataFrame) -> DataFrame:
        """(__key, __now, __was, __present, change) of all keys; ``change`` is null where nothing has."""
        now, was = self._hashed(snapshot), self.state()
        if was is None:
            kind = now.schema["__now"].dataType
            return now.select("__key", "__now", F.lit(None).cast(kind).alias("__was"), F.lit(None).cast("boolean").alias("__present"), F.lit(NEW).alias("change"))
        both = now.join(was, "__key", "full_outer")
        gone, there = F.col("__now").isNull(), F.col("__present")
        change = F.when(there.isNull(), NEW).when(gone & there, VANISHED).when(~gone & ~there, BACK).when(~gone & there & (F.col("__now.__hash") != F.col("__was.__hash")), CHANGED)
        return both.withColumn("change", change)

    def record(self, snapshot: DataFrame, **about) -> dict:
        """Compare, write versions, state and summaries, and set the cursor; ``about`` (source, until) goes into it."""
        run = self.cursor()["run"] + 1
        diff, path = self.difference(snapshot), self._at("difference", run)
        diff.write.mode("overwrite").parquet(path)
        diff = self.spark.read.schema(diff.schema).parquet(path)
        news = diff.where(F.col("change").isNotNull())
        # of equal keys the row whose hash is the chosen one; equal rows are one
        rows = snapshot.withColumn("__hash", F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(snapshot.columns)]), {"ignoreNullFields": "false"}), 256))
        chosen = news.select(F.col("__key"), "change", F.coalesce("__now.__hash", "__was.__hash").alias("hash"))
        row = F.first(F.struct(*[F.col(f"s.{c}") for c in snapshot.columns])).alias("row")
        full = chosen.alias("c").join(rows.alias("s"), (F.col("c.__key") == F.col(f"s.{self.key}")) & (F.col("c.hash") == F.col("s.__hash")), "left")
        versions = full.groupBy(F.col("c.__key").alias("key"), F.col("c.change").alias("change"), F.col("c.hash").alias("hash")).agg(row)
        versions.withColumn("row", F.when(F.col("change") != VANISHED, F.col("row"))).write.mode("overwrite").parquet(self._at("versions", run))
        diff.select("__key", F.coalesce("__now", "__was").alias("__was"), F.col("__now").isNotNull().alias("__present")).write.mode("overwrite").parquet(self._at("state", run))
        if self.facts:
            self._summary(diff, run).write.mode("overwrite").parquet(self._at("summary", run))
        done = {"run": run, **about}
        write_text(self.spark, f"{self.base}/source_cursor", json.dumps(done, default=str))
        for kind, old in (("difference", run), ("state", run - 1), ("summary", run - 1)):
            if exists(self.spark, self._at(kind, old)):
                delete(self.spark, self._at(kind, old))
        return done

    def _summary(self, diff: DataFrame, run: int) -> DataFrame:
        """Groups of the facts with their rows: the run's before, plus what its versions bring, less what they replace."""
        news = diff.where(F.col("change").isNotNull())
        facts = lambda side: [F.col(f"{side}.__{f}").alias(f) for f in self.facts]
        plus = news.where(F.col("__now").isNotNull()).select(*facts("__now"), F.lit(1).cast("long").alias("n"))
        less = news.where(F.col("__present")).select(*facts("__was"), F.lit(-1).cast("long").alias("n"))
        moved = plus.unionAll(less)
        if run > 1:
            moved = moved.unionAll(self.spark.read.parquet(self._at("summary", run - 1)).select(*self.facts, "n"))
        return moved.groupBy(*self.facts).agg(F.sum("n").alias("n")).where("n <> 0")

    def summary(self) -> DataFrame | None:
        """(facts, n): how many present rows have these facts."""
        run = self.cursor()["run"]
        return self.spark.read.parquet(self._at("summary", run)) if run else None

    def versions(self) -> DataFrame | None:
        """(run, key, change, hash, row) of all finished runs."""
        run = self.cursor()["run"]
        if not run:
            return None
        paths = [self._at("versions", k) for k in range(1, run + 1)]
        return self.spark.read.option("basePath", f"{self.base}/versions").parquet(*paths)

    def as_of(self, run: int | None = None, columns: Column | str = "row.*") -> DataFrame | None:
        """The rows that the source had at the end of a run (by default the last one)."""
        found = self.versions()
        if found is None:
            return None
        upto = found.where(F.col("run") <= run) if run is not None else found
        last = upto.groupBy("key").agg(F.max_by(F.struct("change", "row"), "run").alias("v"))
        return last.where(F.col("v.change") != VANISHED).select("v.row").select(columns)
