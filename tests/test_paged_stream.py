"""The paged source as a stream: positions per prefix, refusals, restarts and repeated batches."""

import json
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from foliant.sources import records, remote, replay

OUT = "prefix string, id string, text string"


@pytest.fixture
def api(spark, tmp_path):
    spark.dataSource.register(remote.PagedSource)
    spark.dataSource.register(records.RecordSink)
    df = spark.range(203).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("p"), F.concat(F.lit("ñ\n"), F.col("id").cast("string")).alias("text"))
    replay.keep_pages(df, "id", "p", f"file://{tmp_path}/api", 7)
    return tmp_path, {(("a" if i % 3 == 0 else "b"), str(i), f"ñ\n{i}") for i in range(203)}


def options(base, **more):
    return {"url": f"file://{base}/api", "transport": "foliant.sources.replay:answer", "fields": "id,text", "prefixes": "a,b,none", "pagesize": "10", "pagesperbatch": "1", "persecond": "1e9", "jitter": "0", "retries": "0", "robots": "false", "budget": "100000", "state": f"file://{base}/state", **more}


def start(spark, base, **more):
    stream = spark.readStream.format("paged").options(**options(base, **more)).load()
    return stream.writeStream.format("records").option("path", f"file://{base}/out").option("checkpointLocation", f"{base}/check").trigger(processingTime="0 seconds").start()


def written(spark, base):
    return Counter(tuple(r) for r in records.read(spark, f"file://{base}/out", OUT).collect())


def test_stored_pages_answer_like_the_interface(api):
    base, rows = api
    url = f"file://{base}/api"
    got = [r for r in remote.pages(remote.Client(replay.answer, per_second=1e9, jitter=0, robots=False), url, "a", 4)]
    assert Counter((r["p"], str(r["id"]), r["text"]) for r in got) == Counter(r for r in rows if r[0] == "a")
    assert replay.answer("POST", url, remote.request_body("b", 133, 50), {}).body and json.loads(replay.answer("POST", url, remote.request_body("b", 133, 50), {}).body)["recordsFiltered"] == 135
    assert replay.answer("POST", f"{url}/nowhere", {}, {}).status == 404 and json.loads(replay.answer("POST", url, remote.request_body("none"), {}).body)["documentos"] == []


def test_batch_reader_still_reads_all(spark, api):
    base, rows = api
    df = spark.read.format("paged").options(**options(base)).load()
    assert Counter(tuple(r) for r in df.collect()) == Counter(rows)


def test_a_refusal_stops_the_run_and_the_checkpoint_goes_on(spark, api):
    base, rows = api
    q = start(spark, base)
    while not (q.lastProgress and q.lastProgress.batchId >= 2):
        time.sleep(0.05)
    (base / "api" / "busy").write_text("")
    with pytest.raises(StreamingQueryException, match="503|no total"):
        q.processAllAvailable()
        q.awaitTermination(30)
    some = written(spark, base)
    assert 0 < len(some) < len(rows) and max(some.values()) == 1
    (base / "api" / "busy").unlink()
    q = start(spark, base)
    q.processAllAvailable()
    q.stop()
    assert written(spark, base) == Counter(rows)
    plan = json.loads(next(Path(base / "state").glob("planned.json")).read_text())
    assert plan == {"a": 68, "b": 135, "none": 0}


def test_a_batch_that_ran_without_its_commit_counts_once(spark, api):
    base, rows = api
    q = start(spark, base, pagesperbatch="3")
    q.processAllAvailable()
    q.stop()
    last = max((p for p in Path(base / "check" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    Path(last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    q = start(spark, base, pagesperbatch="3")
    q.processAllAvailable()
    q.stop()
    assert written(spark, base) == Counter(rows)


def test_rows_that_come_later_are_read_from_there_on(spark, api):
    base, rows = api
    q = start(spark, base, pagesperbatch="100")
    q.processAllAvailable()
    q.stop()
    about = json.loads((base / "api" / "about.json").read_text())
    page = base / "api" / "pages" / "prefix=none" / "page=0"
    page.mkdir(parents=True)
    (page / "x.txt").write_text('{"id":900,"p":"none","text":"late"}\n')
    (base / "api" / "about.json").write_text(json.dumps({**about, "totals": {**about["totals"], "none": 1}}))
    (base / "api" / ".about.json.crc").unlink(missing_ok=True)
    q = start(spark, base, pagesperbatch="100")
    q.processAllAvailable()
    q.stop()
    assert written(spark, base) == Counter(rows | {("none", "900", "late")})


def test_pages_share_files_and_every_window_is_answered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "SHELF_BYTES", 1000)
    df = spark.range(203).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("p"), F.concat(F.lit("ñ \x85"), F.repeat(F.lit("x"), F.when(F.col("id") % 3 == 0, 300).otherwise(1))).alias("text"))
    url = f"file://{tmp_path}/api"
    replay.keep_pages(df, "id", "p", url, 7)
    folders = {p: sorted(int(f.name[5:]) for f in (tmp_path / "api" / "pages" / f"prefix={p}").iterdir() if f.is_dir()) for p in "ab"}
    assert folders["a"] == list(range(10)) and 1 < len(folders["b"]) < 10  # 68 large rows: a page a file; 135 small ones in 20 pages
    ask = lambda p, start, n: json.loads(replay.answer("POST", url, remote.request_body(p, start, n), {}).body)
    for p, total in (("a", 68), ("b", 135)):
        rows = ask(p, 0, 1000)["documentos"]
        assert Counter(r["id"] for r in rows) == Counter(i for i in range(203) if (i % 3 == 0) == (p == "a")) and {r["text"][:3] for r in rows} == {"ñ \x85"}
        # the order is by a hash of the key, as it was when each page had a file
        assert [r["id"] for r in rows] == [r["id"] for r in df.where(F.col("p") == p).orderBy(F.md5(F.concat(F.lit("0:orden:"), F.col("id").cast("string")))).collect()]
        for start, n in ((0, 1), (5, 4), (34, 2), (total - 3, 10), (total, 5), (13, 50)):
            assert ask(p, start, n) == {"documentos": rows[start : start + n], "recordsFiltered": total}


def test_readers_share_the_pages_of_a_batch_evenly(spark, api):
    base, rows = api
    reader = remote.PagedStream(options(base, readers="4"), ["id", "text"])
    got = reader.partitions({"a": 10, "b": 0, "none": 0}, {"a": 35, "b": 70, "none": 0})
    assert [len(g.ranges) for g in got] == [2, 3, 2, 3]
    assert [r for g in got for r in g.ranges] == [("a", 10, 20), ("a", 20, 30), ("a", 30, 35), *[("b", n, n + 10) for n in range(0, 70, 10)]]
    assert len(reader.partitions({"a": 60, "b": 130, "none": 0}, {"a": 68, "b": 135, "none": 0})) == 2 and reader.partitions({"a": 68}, {"a": 68}) == []
    q = start(spark, base, pagesperbatch="3", readers="4")
    q.processAllAvailable()
    q.stop()
    assert written(spark, base) == Counter(rows)


def test_plain_rows_of_a_stream_are_the_same_records(spark, tmp_path):
    spark.dataSource.register(records.RecordSink)
    rows = [(1, "ñ\n ", True, None), (None, None, None, "{}"), (-(2**63), "", False, '"')]
    schema = "n long, s string, b boolean, t string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    for name, extra in (("plain", {}), ("other", {"d": F.lit(1.5)})):  # a double goes the way of rows
        q = spark.readStream.schema(schema).parquet(f"{tmp_path}/in").withColumns(extra).writeStream.format("records").option("path", f"file://{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/check-{name}").trigger(availableNow=True).start()
        q.awaitTermination(60)
        got = records.read(spark, f"file://{tmp_path}/{name}", schema + (", d double" if extra else ""))
        assert Counter(tuple(r) for r in got.collect()) == Counter(r + ((1.5,) if extra else ()) for r in rows)
