"""Facts by rule and model, indicators, and the paged source with a transport of its own."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from foliant.operators import extraction, indicators, tables
from foliant.sources import remote

DOC = """===PAGINA 1===
APELACIÓN DE SENTENCIA DE AMPARO
EXPEDIENTES ACUMULADOS 12-2004
CORTE DE CONSTITUCIONALIDAD: Guatemala, cinco de mayo de dos mil cuatro.
===PAGINA 2===
la sentencia dictada por la Sala Primera de Familia, en el amparo que promovió"""


def test_by_rule_and_with_model(spark):
    said = "named_struct('value', {}, 'quote', {}, 'page', 2, 'confidence', cast({} as double))"
    answers = F.expr("named_struct('filed', " + said.format("'uno de enero de dos mil tres'", "'q'", 0.9) + ", 'court', " + said.format("'otra'", "'q'", 0.9) + ", 'outcome', " + said.format("'se revoca'", "'q'", 0.9) + ")")
    card = F.create_map(F.lit("Postulante"), F.lit(" "), F.lit("Solicitante"), F.lit("Ana"), F.lit("Fallo"), F.lit("rara"))
    r = extraction.with_model(extraction.by_rule(spark.range(1).select(F.lit(DOC).alias("text"), card.alias("card"), answers.alias("answers"))), "answers").first()
    assert (r["petitioner"]["value"], r["petitioner"]["evidence"]["quote"]) == ("Ana", "Solicitante: Ana")
    assert (r["case"]["value"], r["case"]["evidence"]["page"], r["case"]["evidence"]["quote"]) == ("12-2004", 1, "EXPEDIENTES ACUMULADOS 12-2004")
    assert (r["decided"]["value"], r["decided"]["confidence"], r["decided"]["note"]) == ("2004-05-05", 0.97, None)
    assert (r["court"]["value"], r["court"]["provenance"], r["court"]["evidence"]["page"]) == ("Sala Primera de Familia", "deterministic", 2)
    assert (r["kind"]["value"], r["outcome"]["value"], r["outcome"]["provenance"]) == ("Apelación De Sentencia De Amparo", "revocado", "llm")
    assert (r["effect"]["value"], r["filed"]["value"]) == ("altera_decision_inferior", "2003-01-01")
    only_rules = extraction.by_rule(spark.range(1).select(F.lit(DOC).alias("text"), card.alias("card"))).first()
    assert (only_rules["outcome"]["value"], only_rules["outcome"]["note"]) == (None, "el portal dice 'rara' y no encaja en la taxonomia literal")


def test_nulls_give_no_facts(spark):
    r = extraction.by_rule(spark.range(1).select(F.lit(None).cast("string").alias("text"), F.lit(None).cast("map<string,string>").alias("card"))).first()
    assert all(r[f] is None for f in ("petitioner", "kind", "outcome", "case", "decided", "court"))


def test_refusals_and_lists(spark):
    a = lambda value, quote, confidence: F.struct(F.lit(value).cast("string").alias("value"), F.lit(quote).cast("string").alias("quote"), F.lit(1).alias("page"), F.lit(confidence).alias("confidence"))
    cases = [a("x", None, 0.9), a("x", "q", 0.1), a("x", "q", 0.9), a(None, None, 0.9)]
    r = spark.range(1).select(*[extraction.refusal(c, c["value"], 0.5) for c in cases], extraction.refusal(cases[2], extraction.as_date(cases[2]["value"]))).first()
    assert tuple(r) == ("descartado sin cita", "descartado por baja confianza", None, None, "valor no convertible")
    doc = F.lit("Firman José Pérez y Ana Gil")
    each = lambda *names: extraction.verify_each(F.array(*[F.lit(n) for n in names]).cast("array<string>"), doc)
    r = spark.range(1).select(each("JOSE PEREZ", "Ana Gil").alias("a"), each("Ana Gil", "Luis").alias("b"), each().alias("c")).first()
    assert (r["a"]["status"], r["b"]["status"], r["b"]["missing"], r["c"]["status"]) == ("verificada", "no_encontrada", ["Luis"], "sin_valor")


def test_small_tables(spark):
    d = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (3, None, 1)], "id int, kind string, size int")
    assert [(r["kind"], r["n"]) for r in tables.counts(d, "kind", "(none)").collect()] == [("a", 2), ("(none)", 1)]
    assert tables.progress(d, named=F.col("kind").isNotNull()).first().asDict() == {"processed": 3, "named": 2}
    with pytest.raises(ValueError, match="not within"):
        tables.capped(d, 11, 10, "id")
    assert [r["id"] for r in tables.capped(d, 2, 10, "id").collect()] == [1, 2]
    assert sorted(r["n"] for r in tables.numbered(d, "id", 7).collect()) == [1, 2, 3]
    many = spark.createDataFrame([(i,) for i in [*range(400), 5, 5, None]], "id long")
    places = sorted((r["n"], r["id"]) for r in tables.numbered(many, "id", 7).collect())
    want = sorted([*range(400), 5, 5, None], key=lambda i: hashlib.md5(("7:orden" if i is None else f"7:orden:{i}").encode()).hexdigest())
    assert places == list(enumerate(want, 1))
    assert tables.numbered(many.limit(0), "id", 7).count() == 0
    assert tables.coverage(d, "size", "kind").where("size = 1").first()["kind_pct"] == 0
    lat = spark.createDataFrame([("2020-01-01", "2020-01-11"), ("2020-01-01", None)], "a string, b string").withColumn("g", F.lit(1))
    assert tuple(indicators.latency(lat, ["g"], "a", "b").first()) == (1, 1, 1, 10.0, 10.0, 10.0, 10.0)
    assert indicators.outcome_rates(d, [], "kind", ["a", "b"]).first().asDict() == {"n": 2, "a_rate": 1.0, "b_rate": 0.0}


def test_links_of_a_large_party_are_a_group(spark):
    left = spark.createDataFrame([(i, "big") for i in range(30)] + [(100, "small"), (101, ""), (102, None)], "id long, party string")
    right = spark.createDataFrame([(1000 + i, "big") for i in range(20)] + [(2000, "small"), (2001, "")], "linked long, party string")
    r = indicators.linked(left, right, "id", "linked", [("party", "party", "party")], most_pairs=100).collect()
    assert [(x["id"], x["linked"], x["signal"]) for x in r if x["group_key"] is None] == [(100, 2000, "party")]
    members = [(x["id"], x["linked"]) for x in r if x["group_key"] == "big"]
    assert sorted(a for a, b in members if b is None) == list(range(30)) and sorted(b for a, b in members if a is None) == list(range(1000, 1020))
    assert indicators.linked(left, right, "id", "linked", [("party", "party", "party")]).count() == 601


def test_a_sample_keeps_few_rows_before_the_shuffle(spark):
    d = spark.range(1000).withColumn("s", (F.col("id") % 10 < 9).cast("string"))
    s = tables.quota_sample(d, "id", "s", 7, 20)
    assert s.count() == 40
    assert "WindowGroupLimit" in s._jdf.queryExecution().executedPlan().toString()


ROWS = {"1": [{"id": f"1{i}", "tags": [i]} for i in range(5)], "2": [{"id": "20"}], "3": []}


def answers(method, url, body, headers):
    if url.endswith("robots.txt"):
        return remote.Response(404, b"")
    rows = ROWS[body["mainSearch"]]
    return remote.Response(200, json.dumps({"recordsFiltered": len(rows), "documentos": rows[body["start"] : body["start"] + body["length"]]}).encode())


def test_paged_source(spark, tmp_path):
    spark.dataSource.register(remote.PagedSource)
    read = spark.read.format("paged").options(url="http://h.test/q", transport="tests.test_extraction:answers", fields="id,tags", prefixes="1,2,3", pageSize="2", perSecond="10000", cache=str(tmp_path / "c"))
    for _ in range(2):
        rows = read.load().collect()
        assert sorted((r["prefix"], r["id"], r["tags"]) for r in rows) == [*[("1", f"1{i}", f"[{i}]") for i in range(5)], ("2", "20", None)]


def client(transport, **options):
    return remote.Client(transport, **{"sleep": lambda s: None, "robots": False, **options})


def test_client_manners():
    seen = []

    def busy(method, url, body, headers):
        seen.append(url)
        return remote.Response(500 if len(seen) < 3 else 200, b"x")

    assert client(busy).ask("GET", "http://h/").attempts == 3
    with pytest.raises(remote.Throttled):
        client(lambda *a: remote.Response(503, b"")).ask("GET", "http://h/")
    with pytest.raises(remote.BudgetSpent):
        c = client(lambda *a: remote.Response(200, b""), budget=1)
        c.ask("GET", "http://h/a")
        c.ask("GET", "http://h/b")
    slept = []
    c = client(lambda *a: remote.Response(200, b""), per_second=0.5, jitter=0, clock=lambda: 10.0, sleep=slept.append)
    c.ask("GET", "http://h/a")
    c.ask("GET", "http://h/b")
    assert slept == [2.0]
    with pytest.raises(remote.RunStopped, match="status 404"):
        list(remote.pages(client(lambda *a: remote.Response(404, b"")), "http://h/", "1", 5))


def test_robots():
    text = "User-agent: *\nDisallow: /x\nCrawl-delay: 3\n\nUser-agent: foliant\nCrawl-delay: 7 # slow\nContent-Signal: ai-train=no\n"
    assert remote.robots_directives(text, "foliant/1") == (7.0, "ai-train=no")
    assert remote.robots_directives(text, "other") == (3.0, None)
    assert not remote.Robots("other", 200, text).allows("http://h/x/1") and remote.Robots("other", 404).allows("http://h/x")
    assert not remote.Robots("other", 500).allows("http://h/") and not remote.Robots("other", None).allows("http://h/")


def test_located(spark):
    """The first match with its place, also behind letters beyond the basic plane, at a line's start and before what only is looked at; each use reads a match that was made once."""
    texts = ["😀 véase el Expediente No. 12-98 y EXPEDIENTES 3-2001", "nada", "", None, "EXPEDIENTE 7-05"]
    d = spark.createDataFrame([(x,) for x in texts], "t string")
    found = d.select(extraction.located(F.col("t"), extraction.CASE).alias("r"))
    assert [r["r"] and tuple(r["r"]) for r in found.collect()] == [("12-98", "Expediente No. 12-98", 12), None, None, None, ("7-05", "EXPEDIENTE 7-05", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("EXPEDIENTES?") == 4
    heads = spark.createDataFrame([("a OPINION CONSULTIVA\n opinión consultiva \nb",), ("dictada por la Sala Ñandú Primera, constituida",)], "t string")
    rows = heads.select(extraction.located(F.col("t"), extraction.HEADING).alias("h"), extraction.located(F.col("t"), extraction.COURT).alias("c")).collect()
    assert rows[0]["h"]["value"] == "opinión consultiva" and rows[0]["h"]["at"] == 22 and rows[1]["h"] is None
    assert rows[1]["c"]["value"] == "Sala Ñandú Primera" and rows[1]["c"]["quote"] == "dictada por la Sala Ñandú Primera"
