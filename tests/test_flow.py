"""Versions with a cursor, summaries with retractions, retries with timers, a sink with commit, counters, and samples without a bound."""

import datetime as dt
import hashlib
import json
import math
import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliant.operators import counters, store, tables
from foliant.sources import records
from foliant.streaming import retries, versions
from foliant.streaming.versions import Versions

CARD = "id long, kind string, year int, note string"


def cards(spark, *rows):
    return spark.createDataFrame(list(rows), CARD)


def changes(v, run):
    return {r["key"]: r["change"] for r in v.versions().where(F.col("run") == run).collect()}


def test_versions_and_summaries_over_runs(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}", "id", ("kind", "year"))
    assert v.cursor() == {"run": 0} and v.versions() is None and v.as_of() is None and v.summary() is None
    runs = [
        [(1, "a", 2020, None), (2, "a", 2021, "x"), (3, None, None, "y"), (None, "a", 2020, "no key"), (2, "a", 2021, "x")],
        [(1, "b", 2020, None), (2, "a", 2021, "x"), (4, "a", 2021, None)],  # 1 changes its kind, 3 goes, 4 comes
        [(2, "a", 2021, "X"), (3, None, None, "y")],  # 1 and 4 go, 2's note changes, 3 is back as it was
        [],
        [(1, "b", 2020, None), (5, "c", None, None)],
    ]
    want = [{1: "new", 2: "new", 3: "new"}, {1: "changed", 3: "vanished", 4: "new"}, {1: "vanished", 2: "changed", 3: "back", 4: "vanished"}, {2: "vanished", 3: "vanished"}, {1: "back", 5: "new"}]
    for i, (rows, changed) in enumerate(zip(runs, want, strict=True), 1):
        done = v.record(cards(spark, *rows), source="portal", until=f"2020-01-0{i}")
        assert done == v.cursor() == {"run": i, "source": "portal", "until": f"2020-01-0{i}"}
        assert changes(v, i) == changed
        now = {tuple(r) for r in rows if r[0] is not None}
        assert {tuple(r) for r in v.as_of(columns="*").select("row.*").collect()} == now if rows else v.as_of().count() == 0
        assert {tuple(r) for r in v.summary().collect()} == {(*k, n) for k, n in Counter((r[1], r[2]) for r in now).items()}
        for k in range(1, i + 1):  # the past stays what it was
            assert {tuple(r) for r in v.as_of(k).collect()} == {tuple(r) for r in runs[k - 1] if r[0] is not None}
    assert v.record(cards(spark, *runs[-1]))["run"] == 6 and changes(v, 6) == {}


def test_a_run_that_stops_before_its_cursor_is_done_again(spark, tmp_path, monkeypatch):
    v = Versions(spark, f"file://{tmp_path}", "id", ("kind",))
    v.record(cards(spark, (1, "a", 1, None), (2, "a", 1, None)))
    before = sorted(map(str, v.as_of().collect()))
    real = versions.write_text

    def stop(*a):
        raise OSError("no more disk")

    monkeypatch.setattr(versions, "write_text", stop)
    with pytest.raises(OSError):
        v.record(cards(spark, (1, "b", 1, None), (3, "c", 1, None)))
    monkeypatch.setattr(versions, "write_text", real)
    assert v.cursor()["run"] == 1 and sorted(map(str, v.as_of().collect())) == before
    assert {tuple(r) for r in v.summary().collect()} == {("a", 2)}
    v.record(cards(spark, (1, "b", 1, None), (4, "d", 1, None)))  # another snapshot than the one that broke off
    assert changes(v, 2) == {1: "changed", 2: "vanished", 4: "new"}
    assert {tuple(r) for r in v.summary().collect()} == {("b", 1), ("d", 1)}


def test_rows_that_repeat_a_key_count_once(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}", "id", ("kind",))
    two = [(1, "a", 1, "x"), (1, "b", 1, "y")]
    v.record(cards(spark, *two))
    first = v.as_of().collect()
    v.record(cards(spark, *reversed(two)))
    assert len(first) == 1 and changes(v, 2) == {} and v.summary().first()["n"] == 1


T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
LOG = "id long, outcome string, at timestamp, seq long"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def feed(spark, folder, name, rows):
    """One file, moved in when it is whole."""
    side = f"{folder}-{name}"
    spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(side)
    os.makedirs(folder, exist_ok=True)
    os.rename(next(Path(side).glob("*.parquet")), f"{folder}/{name}.parquet")


def test_retries_with_late_lines_restarts_timers_and_expiry(spark, tmp_path):
    source, target, check = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    go = lambda: retries.run(spark, source, spark.createDataFrame([], LOG).schema, lambda d: d, target, check, ["ok"], "10 hours", keep=100 * 3600)
    feed(spark, source, "a", [(1, "failed", at(0), 1), (2, "ok", at(0), 2), (3, "failed", at(1), 3), (3, "failed", at(2), 4), (4, "failed", at(0), 1)])
    go()
    feed(spark, source, "b", [(1, "ok", at(5), 5), (3, "ok", at(0), 6), (9, "ok", at(30), 7)])  # 3's line is late: its later failure stands
    go()
    state = {r["id"]: (r["outcome"], r["tries"], r["next_try"]) for r in retries.latest(spark, target).collect()}
    naive = lambda hours, tries: (at(hours) + dt.timedelta(hours=2 ** (min(tries, 6) - 1))).replace(tzinfo=None)
    assert state == {1: ("ok", 2, None), 2: ("ok", 1, None), 3: ("failed", 3, naive(2, 3)), 4: ("failed", 1, naive(0, 1)), 9: ("ok", 1, None)}
    feed(spark, source, "c", [(9, "ok", at(150), 8), (5, "failed", at(145), 9)])
    go()
    feed(spark, source, "d", [(3, "ok", at(1), 10), (9, "ok", at(151), 11)])  # 3's line is behind the watermark and too late
    go()
    told = retries.told(spark, target)
    due = Counter((r["id"], r["next_try"]) for r in told.where("kind = 'due'").collect())
    assert due[4, naive(0, 1)] == 1 and due[3, naive(2, 3)] == 1 and max(due.values()) == 1
    assert {r["id"] for r in told.where("kind = 'forgotten'").collect()} == {1, 2, 3, 4}
    assert {r["id"] for r in retries.latest(spark, target).collect()} == {5, 9}
    assert [r["id"] for r in retries.to_try(spark, target, at(200)).collect()] == [5]
    rows = told.count()
    go()  # nothing new
    assert retries.told(spark, target).count() == rows


@pytest.fixture
def sink(spark):
    spark.dataSource.register(records.RecordSink)


ROW = "id long, name string, parts array<string>, more struct<a:int,b:string>, raw binary, day date"


def rows_of(n):
    return [(i, f"ñ\n{i}" if i % 3 else None, ["x", None] if i % 2 else None, (i, "b") if i % 4 else None, bytes([i % 256, 255]), dt.date(2020, 1, 1 + i % 28)) for i in range(n)]


def test_records_come_back(spark, sink, tmp_path, monkeypatch):
    df = spark.createDataFrame(rows_of(50), ROW).repartition(3)
    for _ in range(2):
        df.write.format("records").option("path", str(tmp_path)).mode("append").save()
    back = records.read(spark, str(tmp_path), df.schema)
    assert Counter(map(str, back.collect())) == Counter(2 * list(map(str, df.collect())))
    for name in (p.name for p in (tmp_path / "parts").iterdir()):
        assert hashlib.sha256((tmp_path / "parts" / name).read_bytes()).hexdigest() == name.split("-")[0]
    df.where("id < 5").write.format("records").option("path", str(tmp_path)).mode("overwrite").save()
    assert records.read(spark, str(tmp_path), df.schema).count() == 5
    assert records.read(spark, str(tmp_path), df.schema).where("id is null").count() == 0


def test_a_job_that_fails_leaves_nothing(spark, sink, tmp_path):
    bad = spark.range(100, numPartitions=4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise("ok").alias("v"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("records").option("path", str(tmp_path)).mode("append").save()
    assert not list((tmp_path / "manifests").glob("*")) if (tmp_path / "manifests").exists() else True
    time.sleep(1)  # tasks that the job ended may still be writing
    records.sweep(str(tmp_path))
    assert not list(tmp_path.glob("parts/*"))
    spark.range(3).write.format("records").option("path", str(tmp_path)).mode("append").save()
    assert sorted(r["id"] for r in records.read(spark, str(tmp_path), "id long").collect()) == [0, 1, 2]
    (tmp_path / "parts" / "0-lost-1.json").write_text('{"id":9}\n')
    assert records.sweep(str(tmp_path)) == 1 and records.read(spark, str(tmp_path), "id long").count() == 3


def test_parts_have_a_bound_and_a_task_that_fails_takes_its_own_back(tmp_path, monkeypatch):
    monkeypatch.setattr(records, "PART_BYTES", 40)
    w = records.RecordWriter(str(tmp_path), ["id", "v"], False)
    done = w.write(iter([(i, "x" * (5 if i != 3 else 100)) for i in range(10)]))
    assert done.records == 10 and all(len((tmp_path / p).read_bytes()) <= 40 or (tmp_path / p).read_bytes().count(b"\n") == 1 for p in done.parts)
    w.commit([done, None])
    before = set((tmp_path / "parts").iterdir())

    def rows():
        yield from ((i, "y" * 30) for i in range(3))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        w.write(rows())
    assert set((tmp_path / "parts").iterdir()) == before
    manifest = json.loads(next((tmp_path / "manifests").iterdir()).read_text())
    assert manifest == {"parts": sorted(done.parts), "records": 10}


def test_a_repeated_batch_of_a_stream_counts_once(spark, sink, tmp_path):
    w = records.RecordStreamWriter(str(tmp_path), ["id"])
    for _ in range(2):  # the batch ran, its commit did, and the checkpoint's didn't
        w.commit([w.write(iter([(1,), (2,)]))], 0)
    w.commit([w.write(iter([(3,)]))], 1)
    assert sorted(r["id"] for r in records.read(spark, str(tmp_path), "id long").collect()) == [1, 2, 3]
    spark.range(7).write.parquet(f"{tmp_path}/source")
    for _ in range(2):
        q = spark.readStream.schema("id long").parquet(f"{tmp_path}/source").writeStream.format("records").option("path", f"{tmp_path}/stream").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r["id"] for r in records.read(spark, f"{tmp_path}/stream", "id long").collect()) == list(range(7))


def test_counters_come_with_the_run(spark, tmp_path):
    df = spark.range(100).withColumn("odd", F.col("id") % 2 == 1)
    table, audit = counters.cut_counted(df, "numbers", odd=F.count_if("odd"), total=F.sum("id"))
    assert table.count() == 100
    assert {r["counter"]: r["value"] for r in audit.collect()} == {"rows": 100, "odd": 50, "total": 4950}
    _, none = counters.cut_counted(df.limit(0), "none", total=F.sum("id"))
    assert {r["counter"]: r["value"] for r in none.collect()} == {"rows": 0, "total": 0}
    df.write.parquet(f"{tmp_path}/in")
    with counters.StreamCounters(spark) as seen:
        watched = seen.watch(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "stream", odd=F.count_if("odd"))
        watched.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    got = Counter()
    for r in seen.rows().collect():
        got[r["counter"]] += r["value"]
    assert got == {"rows": 100, "odd": 50}


@pytest.mark.parametrize("digits", [4, 1])
def test_samples_without_a_bound_equal_the_sorted_ones(spark, digits, monkeypatch):
    monkeypatch.setattr(tables, "PREFIX", digits)
    rows = [(i, "hot" if i % 10 else ("b" if i % 20 else None)) for i in range(3000)] + [(9001, "one"), (9002, "two"), (9003, "two")]
    df = spark.createDataFrame(rows, "id long, s string")
    order = lambda s, i: (hashlib.md5(f"7:{s}:{i}".encode()).hexdigest(), str(i))
    for size, count in ((F.ceil(F.col("stratum_n") / 2), lambda n: math.ceil(n / 2)), (F.col("stratum_n"), lambda n: n), (F.col("stratum_n") - F.col("stratum_n"), lambda n: 0), (F.least(F.lit(5), F.col("stratum_n")), lambda n: min(5, n))):
        want = set()
        for s in ("hot", "b", "one", "two"):
            ids = sorted((i for i, x in rows if x == s), key=lambda i, s=s: order(s, i))
            want |= set(ids[: count(len(ids))])
        got = tables.stratified_sample(df, "id", "s", 7, size)
        assert sorted(r["id"] for r in got.collect()) == sorted(want)
        assert got.columns[-2:] == ["stratum_n", "sample_n"]


@pytest.mark.parametrize("shared", [100_000, 1])
def test_no_task_gets_the_rows_of_a_stratum(spark, shared, monkeypatch):
    monkeypatch.setattr(tables, "SHARED_STRATA", shared)
    monkeypatch.setattr(store, "HOT_ROWS", 50)
    df = spark.range(900).select(F.col("id"), F.when(F.col("id") < 700, "a").when(F.col("id") < 890, "b").otherwise("c").alias("s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = tables.stratified_sample(df, "id", "s", 7, F.ceil(F.col("stratum_n") / 2))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("__part" in plan) if shared == 1 else ("SortMergeJoin" not in plan)
        rows = [tuple(r) for r in got.select("s", "id").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = {s: sorted((hashlib.md5(f"7:{s}:{i}".encode()).hexdigest(), str(i), i) for i in r) for s, r in (("a", range(700)), ("b", range(700, 890)), ("c", range(890, 900)))}
    assert sorted(rows) == sorted((s, x[2]) for s, k in keys.items() for x in k[: -(-len(k) // 2)])


def test_one_message_for_a_state():
    """An id's state is asked for once a batch, there or not."""
    from types import SimpleNamespace

    asked, kept = [], []
    state = SimpleNamespace(get=lambda: asked.append("get") or (kept[-1] if kept else None), exists=lambda: asked.append("exists") or bool(kept), update=kept.append)
    timers = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    handle = SimpleNamespace(getValueState=lambda *_: state, registerTimer=lambda _: None, deleteTimer=lambda _: None)
    p = retries.Attempts(["ok"])
    p.init(handle)
    lines = [SimpleNamespace(at=5, seq=1, outcome="no"), SimpleNamespace(at=4, seq=2, outcome="ok")]
    assert [r["tries"] for r in p.handleInputRows((1,), iter(lines), timers)] == [2]
    assert [(r["tries"], r["outcome"]) for r in p.handleInputRows((1,), iter([SimpleNamespace(at=9, seq=3, outcome="ok")]), timers)] == [(3, "ok")]
    assert asked == ["get", "get"]
