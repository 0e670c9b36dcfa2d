"""Collecting, sinks, PDF tools, configuration and the model's client, all without a network."""

import io
import json
import stat
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from foliant.functions import text
from foliant.operators import discovery, extraction, model, responses, study, tables
from foliant.sources import collector, pdf, readers, remote, sinks

FILE = b"%PDF-" + b"x" * 3000
CARD = "<html>Atributos del Expediente " + "palabra " * 300 + "<table><tr><td>No. Expediente</td><td>1-2000</td></tr><tr><td>Fallo</td></tr></table></html>"
ROWS = [{"id": i % 4, "pdf": f"http://h.test/{i % 4}.pdf" if i % 4 else None, "fechaSentencia": "2013-01-02"} for i in range(6)]


def transport(method, url, body, headers):
    if url.endswith("/api"):
        part = ROWS[body["start"] : body["start"] + body["length"]] if body["mainSearch"] == "amparo" else []
        return remote.Response(200, json.dumps({"documentos": part, "recordsTotal": len(part), "recordsFiltered": len(ROWS)}).encode(), {"Content-Type": "application/json"})
    if "card" in url:
        return remote.Response(200, CARD.encode(), {"Content-Type": "text/html"}) if not url.endswith("=2") else remote.Response(202, b"", {"Content-Type": "text/html"})
    if url.endswith("3.pdf"):
        raise OSError("gone")
    return remote.Response(200, FILE, {"Content-Type": "application/pdf"})


def client(send=transport, **options):
    return remote.Client(send, **{"sleep": lambda s: None, "robots": False, "per_second": 1e9, "jitter": 0, **options})


def test_request_body():
    b = remote.request_body("amparo", start=20, length=10, draw=3)
    assert [c["data"] for c in b["columns"]] == list(remote.COLUMNS["expediente"])
    assert (b["mainSearch"], b["start"], b["length"], b["draw"]) == ("amparo", 20, 10, 3)
    assert [c["data"] for c in b["columns"] if not c["orderable"]] == ["expedientes", "id", "pdf"]


def test_a_page_that_fails_is_not_checked():
    rows, total, verdict, _ = remote.page(client(), "http://h.test/api", "amparo", 0, 4)
    assert (len(rows), total, verdict) == (4, 6, ("ok", None))
    assert remote.page(client(lambda *a: remote.Response(202, b"")), "http://h/api", "x", 0, 4)[:3] == ([], -1, ("empty_body", "HTTP 202 con cuerpo vacio"))

    def down(*a):
        raise OSError("down")

    assert remote.page(client(down, retries=0), "http://h/api", "x", 0, 4)[1:3] == (-1, ("not_checked", "consulta fallida: OSError: down"))


def test_discovery(tmp_path):
    plan = collector.Discovery("src", "http://h.test/api", "http://h.test/card", str(tmp_path), page_length=4)
    found = list(collector.discover(client(retries=0), plan, ["nada", "amparo"], 10, "run"))
    assert [r["source_document_id"] for r in found] == ["0", "1", "2", "3"]
    assert [(r["source"]["page_start"], r["source"]["rank_in_page"]) for r in found] == [(0, 0), (0, 1), (0, 2), (0, 3)]
    assert [r["attributes"] and r["attributes"]["Fallo"] for r in found] == ["", "", None, ""]
    assert [r["document"] and r["document"]["sha256"] is not None for r in found] == [None, True, True, False]
    assert found[3]["document"]["fetch"]["outcome"] == "not_checked"
    assert len(list(collector.discover(client(), plan, ["amparo"], 2, "run"))) == 2


def test_downloads_take_the_cheapest_way(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    (root / "old.pdf").write_bytes(FILE)
    cache = remote.DiskCache(str(tmp_path / "c"))
    cache.put("GET", "http://h.test/2.pdf", None, remote.Response(200, FILE, {"Content-Type": "application/pdf"}))
    cache.put("GET", "http://h.test/5.pdf", None, remote.Response(200, b"short", {"Content-Type": "application/pdf"}))
    wanted = [{"id": i, "pdf": f"http://h.test/{i}.pdf" if i else None, "year": 2000} for i in (0, 1, 2, 3, 4, 5)]
    previous = {"1": {"path": "old.pdf", "bytes": len(FILE), "sha256": "s"}, "4": {"path": "old.pdf", "bytes": 7, "sha256": "s"}}
    got = list(collector.download(client(retries=0), wanted, root, "src", previous=previous, cache=cache))
    assert [(r["origin"], r["outcome"]) for r in got] == [(None, "not_checked"), ("previo", "ok"), ("cache", "ok"), ("red", "not_checked"), ("red", "ok"), ("red", "ok")]
    assert got[2]["path"] == got[4]["path"] and (root / got[2]["path"]).read_bytes() == FILE
    assert list(collector.download(client(), wanted, root, "src", done={str(i) for i in range(6)})) == []
    stopped = list(collector.download(client(lambda *a: remote.Response(503, b"")), wanted[1:], root, "src"))
    assert len(stopped) == 1 and stopped[0]["stopped"].startswith("Throttled")
    with pytest.raises(sinks.DestinationMissing):
        list(collector.download(client(), wanted, tmp_path / "none", "src"))
    with pytest.raises(sinks.DestinationMissing, match="needed"):
        sinks.check_destination(root, 1 << 60)


def test_a_cache_hit_is_judged_again(tmp_path):
    cache = remote.DiskCache(str(tmp_path))
    cache.put("GET", "http://h.test/1.pdf", None, remote.Response(200, b"old", {"Content-Type": "application/pdf"}))
    c = client(cache=cache)
    assert c.ask("GET", "http://h.test/1.pdf").body == b"old"
    assert c.ask("GET", "http://h.test/1.pdf", expect=responses.PDF).body == FILE
    assert c.ask("GET", "http://h.test/1.pdf", expect=responses.PDF).attempts == 0


def test_sinks(tmp_path):
    sink = sinks.LineSink(tmp_path / "a" / "log.jsonl")
    assert sink.done() == set()
    assert sink.write([{"id": 1, "ü": None}, {"id": "2"}]) == 2
    (tmp_path / "a" / "log.jsonl").open("a").write("{cut off")
    assert sink.done() == {"1", "2"}
    path, digest, there = sinks.store_immutable(tmp_path, "src", None, b"x", ".pdf")
    assert (path, there) == (tmp_path / "src" / "unknown" / f"{digest}.pdf", False)
    assert sinks.store_immutable(tmp_path, "src", None, b"x", "pdf")[2]
    out = io.StringIO()
    sinks.event_log(out).info("fetched", extra={"fields": {"status": 200}})
    event = json.loads(out.getvalue())
    assert (event["event"], event["level"], event["status"]) == ("fetched", "info", 200)
    assert datetime.fromisoformat(event["timestamp"]).tzinfo == UTC


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text('source_id = "s"\ncontact_url = "u"\nseed_queries = ["a"]\njitter = 0.5\n')
    c = sinks.load_config(tmp_path / "c.toml")
    assert (c.source_id, c.jitter, c.seed_queries, c.max_attempts) == ("s", 0.5, ("a",), 3)
    for bad, why in (('source_id = "s"\n', "missing settings: contact_url"), ('source_id = "s"\ncontact_url = "u"\nx = 1\n', "unknown settings: x")):
        (tmp_path / "b.toml").write_text(bad)
        with pytest.raises(ValueError, match=why):
            sinks.load_config(tmp_path / "b.toml")


def program(folder, name, script):
    path = folder / name
    path.write_text("#!/bin/sh\n" + script)
    path.chmod(path.stat().st_mode | stat.S_IEXEC)
    return str(path)


def test_pdf_tools(spark, tmp_path):
    df = spark.createDataFrame([(1, bytearray(b"good")), (2, bytearray(b"bad"))], "id long, content binary")
    fail = 'grep -q bad "$F" && { echo broken >&2; exit 3; }\n'
    info = program(tmp_path, "info", 'F="$1"\n' + fail + 'printf "Pages:  5\\nProducer: Word 2016\\n"\n')
    assert [tuple(r) for r in pdf.profiles(df, tool=info).orderBy("id").collect()] == [(1, 5, "Word 2016", None, None), (2, None, None, None, "code 3: broken\n")]
    words = program(tmp_path, "words", 'F="$2"\n' + fail + 'printf "one\\ftwo\\f\\n"\n')
    assert [(r["pages"], r["failed"] is None) for r in pdf.page_texts(df, tool=words).orderBy("id").collect()] == [(["one", "two"], True), (None, False)]
    again = program(tmp_path, "again", 'F="$4"\n' + fail + 'printf "new" > "$5"\n')
    assert [r["content"] for r in pdf.ocr(df, tool=again).orderBy("id").collect()] == [bytearray(b"new"), None]
    with pytest.raises(pdf.ToolMissing):
        pdf.profiles(df, tool="no-such-program")


def test_asking_a_model(spark):
    class Declines:
        def extract(self, system, user, schema):
            assert "minimum" not in json.dumps(schema)
            if "refuse" in user:
                raise model.Refusal("no")
            return ({"other": 1} if "odd" in user else {"filed": {"value": "uno de mayo de dos mil", "quote": "q", "page": 1, "confidence": 0.9}}), {"input_tokens": 5, "output_tokens": 2}

    texts = [(1, "fine"), (2, "refuse"), (3, "odd"), (4, "x" * (extraction.LONGEST_TEXT + 1)), (5, None)]
    df = spark.createDataFrame(texts, "id long, text string").withColumn("known", F.lit("- case: 1"))
    prompt = model.Prompt("v1", "system", "{known}\n{text}")
    r = model.ask(df, "text", "known", Declines, prompt).orderBy("id").collect()
    assert [x["warning"] and x["warning"].split(":")[0] for x in r] == [None, "el modelo declino", "respuesta fuera del esquema", f"documento de {extraction.LONGEST_TEXT + 1} caracteres, por encima del limite de {extraction.LONGEST_TEXT}", "documento de 0 caracteres, por encima del limite de 120000"]
    assert [(x["input_tokens"], x["prompt_sha256"]) for x in r[:2]] == [(5, prompt.sha256), (None, prompt.sha256)]
    fine = model.answers(spark.createDataFrame([(r[0]["answer"],)], "answer string")).select(extraction.said(F.col("answer.filed"), extraction.as_date).alias("f")).first()["f"]
    assert (fine["value"], fine["provenance"]) == ("2000-05-01", "llm")


def test_officers_and_citations_come_from_the_model(spark):
    kind = "struct<officers:struct<value:array<struct<name:string,role:string>>,quote:string,page:int,confidence:double>,citations:struct<value:array<struct<case:string,text:string>>,confidence:double>>"
    rows = [(("t", {"a": "b"}, ((([("Ana", "signer")], "firma Ana", 3, 0.8)), ([("1-98", "véase")], 2.0)))), ("t", None, (([("Ana", "signer")], None, 3, 0.8), ([], 0.1)))]
    df = spark.createDataFrame(rows, f"text string, card map<string,string>, answers {kind}")
    r = extraction.with_model(extraction.by_rule(df), "answers").collect()
    assert (r[0]["officers"]["value"][0]["name"], r[0]["officers"]["evidence"]["page"], r[0]["citations"]["confidence"], r[0]["warnings"]) == ("Ana", 3, 1.0, [])
    assert (r[1]["officers"], r[1]["citations"], r[1]["warnings"]) == (None, None, ["magistrados propuestos sin cita: descartados"])


def test_readers_and_small_writers(spark, tmp_path):
    d = spark.createDataFrame([(1, "a;b"), (2, "")], "id int, name string")
    readers.append_jsonl(d, f"{tmp_path}/j")
    readers.append_jsonl(d, f"{tmp_path}/j")
    assert readers.read_jsonl(spark, f"{tmp_path}/j", "id int, name string").count() == 4
    readers.review_sheet(d, f"{tmp_path}/sheet", ["id", "name", "note"], ["note"])
    assert sorted(tuple(r) for r in readers.read_csv(spark, f"{tmp_path}/sheet", "id int, name string, note string").collect()) == [(1, "a;b", ""), (2, "", "")]
    assert json.loads(readers.summary_json(d.where("id = 1")).first()["value"]) == {"id": 1, "name": "a;b"}
    raw = spark.createDataFrame([(bytearray("canción – ".encode() + b"\x97"),), (None,)], "c binary")
    assert [r["x"] for r in raw.select(readers.repaired("c").alias("x")).collect()] == ["canción – ó", None]
    blobs = spark.createDataFrame([(bytearray(b"x"),), (bytearray(b"x"),), (bytearray(b"y"),)], "content binary")
    first = readers.store_blobs(blobs, None, "content")
    assert first.count() == 2 and readers.store_blobs(blobs, first, "content").count() == 0
    assert spark.range(1).select(text.join_pages(F.array(F.lit("a"), F.lit("b")))).first()[0] == "===PAGINA 1===\na\n===PAGINA 2===\nb"
    assert spark.range(1).select(text.html_clean(F.lit(" a&amp;b&nbsp; c "))).first()[0] == "a&b c"


def test_samples_designs_and_stamps(spark):
    d = spark.range(60).select("id", (F.col("id") % 2 + 2010).alias("year"))
    assert [r["id"] for r in tables.shuffled(d, "id", 1).limit(5).collect()] == [r["id"] for r in tables.shuffled(d, "id", 1).collect()][:5]
    sample = tables.stratified_sample(d, "id", "year", 1)
    one = tables.design(sample, "year", 1, 0.05, d, "id").first()
    assert (one["since"], one["until"], one["total_n"], one["sampled"], one["strata"]["2010"]["universe"], one["census_rows"]) == (2010, 2011, 60, 56, 30, 60)
    assert one["census_hash"] == tables.design(sample, "year", 1, 0.05, d.orderBy(F.desc("id")), "id").first()["census_hash"]
    s = tables.stamped(d.limit(1), "r1", {"parser": "2"}).first()
    assert (s["run_id"], s["parser_version"]) == ("r1", "2")
    cards = spark.createDataFrame([(1, "A", 2010), (2, "A", 2012), (3, "AB", 2010), (4, "A", 1999), (5, "A", 2010)], "id long, kind string, year int")
    census = spark.createDataFrame([(1, "u"), (2, ""), (3, "u"), (4, "u"), (1, "v")], "id long, pdf string")
    assert [tuple(r) for r in study.eligible(cards, census, "A").collect()] == [(1, "A", 2010, "2003-2010", "v")]
    assert study.in_years(cards, "year", 2010, 2011).count() == 3
    edges = discovery.resolved(spark.createDataFrame([(1, "61-98"), (2, "zz")], "id long, cited_case string"), spark.createDataFrame([(7, ["61-1998"]), (8, ["61-98"])], "id long, cases array<string>"), 2026)
    assert sorted((r["id"], r["cited_id"], r["documents"]) for r in edges.collect()) == [(1, 7, 2), (2, None, None)]
