from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from foliant.operators import evidence, people, responses, tables
from foliant.plans import registry
from foliant.sources import readers
from foliant.streaming import incremental

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_oracle(spark, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=repr)
    assert got
    if name in registry.ORACLES:
        con = duckdb.connect()
        con.execute("set timezone='UTC'")
        for table in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
            con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
        cursor = con.execute(registry.ORACLES[name])
        at = [[d[0] for d in cursor.description].index(c) for c in columns]
        assert got == sorted([tuple(plain(r[i]) for i in at) for r in cursor.fetchall()], key=repr)


def test_sample_properties(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3 + 2009).alias("year"))
    sample = lambda d, seed=1: {(r["year"], r["id"]) for r in tables.stratified_sample(d, "id", "year", seed).collect()}
    whole, fewer = sample(df), sample(df.where("year <> 2011"))
    assert whole == sample(df)
    assert whole != sample(df, 2)
    assert {x for x in whole if x[0] != 2011} == fewer
    assert len([x for x in whole if x[0] == 2010]) == 278


def test_keep_first_last_and_resume(spark):
    log = spark.createDataFrame([("a", 1, "ok"), ("a", 2, "error"), ("b", 1, "ok"), ("b", 1, "ok"), ("c", 1, "error"), ("c", 3, "ok")], "id string, at int, outcome string")
    assert {(r["id"], r["outcome"]) for r in tables.keep(log, "id", "at").collect()} == {("a", "error"), ("b", "ok"), ("c", "ok")}
    assert {(r["id"], r["outcome"]) for r in tables.keep(log, "id", "at", "first").collect()} == {("a", "ok"), ("b", "ok"), ("c", "error")}
    done = tables.done_keys(log, "id", "outcome", "at", ["ok"])
    assert [r["id"] for r in tables.pending(log.select("id").distinct(), done, "id").collect()] == ["a"]
    assert tables.pending(log, tables.done_keys(log, "id", "outcome", "at", ["ok"], retry_failed=False), "id").count() == 0


def test_census_counts_a_document_once_per_year(spark):
    c = spark.createDataFrame([("1", ["300-2015", "400-2017"], "A", "x", 1), ("2", ["1-2016"], None, None, 2), ("3", ["2-15"], "A", "x", 3), ("3", ["2-15"], "B", "x", 4)], "id string, cases array<string>, kind string, decided string, ord int")
    s = tables.census_summary(c, 2026).first()
    assert (s["documents"], s["cases"], s["missing_date"]) == (3, 4, 1)
    assert s["by_year"] == {"2015": 2, "2016": 1, "2017": 1}
    assert s["by_kind"] == {"A": 2, "(sin tipo)": 1}
    assert (s["underivable"], s["by_reason"]) == (0, {})
    odd = tables.census_summary(c.selectExpr("id", "array('x', 'x', '1-200') as cases", "kind", "decided", "ord"), 2026).first()
    assert (odd["cases"], odd["underivable"], odd["by_reason"]) == (2, 2, {"sin guion": 1, "longitud del anio": 1})
    empty = tables.census_summary(c.limit(0), 2026).first()
    assert empty["documents"] == 0


def test_weighted_accuracy_and_zero_fill(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 30)], "stratum string, size int")
    right = spark.createDataFrame([("a", True), ("a", False)], "stratum string, right boolean")
    assert tables.weighted_accuracy(right, sizes).first()["weighted"] == 0.125
    assert tables.weighted_accuracy(right, sizes, renormalize=True).first()["weighted"] == 0.5
    assert {(r["stratum"], r["n"]) for r in tables.zero_filled_counts(right, "stratum", ["a", "z"]).collect()} == {("a", 2), ("z", 0)}


def test_people_are_merged_in_order(spark):
    rows = [("Ana de la Paz Soto Mora", 1996, 2000, 1), ("Ana Soto Mora", 2003, 2010, 2), ("Eva Sol Luna", 2001, 2001, 3), ("Eva Sol Lunas", 2002, 2002, 4)]
    p = people.people(spark.createDataFrame(rows, "name string, since int, until int, ord int"), {"Eva Sol Lunas": ("SOLLUNA",)}).orderBy("ord").collect()
    assert [(x["name"], x["keys"], x["loose"]) for x in p] == [("Ana de la Paz Soto Mora", ["SOTOMORA"], ["ANA", "SOTO", "MORA"]), ("Eva Sol Luna", ["SOLLUNA", "SOLLUNAS"], ["EVA", "SOL", "LUNA"])]
    assert [tuple(t) for t in p[0]["terms"]] == [(date(1996, 4, 14), date(2001, 4, 13)), (date(2003, 1, 1), date(2011, 4, 13))]
    assert people.people(spark.createDataFrame([], "name string, since int, until int, ord int")).count() == 0
    found = people.in_office(people.people(spark.createDataFrame(rows, "name string, since int, until int, ord int")), F.lit("2003-06-01").cast("date"))
    assert [r["name"] for r in found.collect()] == ["Ana de la Paz Soto Mora", "Eva Sol Lunas"]


def test_quotes_and_annotation(spark):
    q = lambda quote, provenance="llm": evidence.extracted(F.lit("v"), 0.9, provenance, F.lit(quote).cast("string"))
    doc = F.lit("Uno ===PAGINA 2=== dos - tres Árbol")
    r = spark.range(1).select(*[evidence.verify_quote(x, doc) for x in (q("uno dos-tres arbol"), q("uno tres"), q(None), q(None, "portal"))]).first()
    assert tuple(r) == ("verificada", "no_encontrada", "sin_evidencia", "verificada")
    assert spark.range(1).select(evidence.annotate(F.lit("n"), F.lit("no_encontrada"), F.lit("x"))).first()[0] == "n; EVIDENCIA no_encontrada: x"


def test_short_quotes_are_found(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma"), (2, "Alpha betas"), (3, None), (4, "")], "d long, text string")
    q = spark.createDataFrame([(1, "beta"), (2, "alpha beta"), (3, "alpha beta gamma"), (4, "pha bet"), (5, ""), (6, None), (7, "zz")], "q long, text string")
    assert sorted((r["d"], r["q"]) for r in evidence.quotes_in(d, q, "d", "q").collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 4)]
    assert evidence.quotes_in(d, q.limit(0), "d", "q").count() == 0


@pytest.mark.parametrize("body", [b"", b"x" * 10, b"Just a moment...", b'{"documentos": [], "recordsTotal": 0}', b"[1]", b'{"documentos": 1}', b"{bad", b"%PDF-" + b"y" * 3000, b"w " * 3000])
@pytest.mark.parametrize("expect", [responses.API, responses.CARD, responses.PDF, responses.ROBOTS_FILE])
def test_both_forms_of_a_verdict_agree(spark, body, expect):
    cases = [(status, kind) for status in (200, 403, 503, None) for kind in (expect.content_type, "x/y")]
    df = spark.createDataFrame([(s, bytearray(body), k) for s, k in cases], "status int, body binary, kind string")
    got = [tuple(r["x"]) for r in df.coalesce(1).select(responses.fetch_outcome(F.col("status"), F.col("body"), F.col("kind"), expect).alias("x")).collect()]
    assert got == [responses.evaluate(s, body, k, expect) for s, k in cases]


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1"}\n\n{"id": "2", "extra": 1}\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/a.jsonl", "id string").count() == 2
    assert readers.read_jsonl(spark, f"{tmp_path}/none.jsonl", "id string").count() == 0
    with pytest.raises(Exception, match="unknown fields"):
        readers.read_jsonl(spark, f"{tmp_path}/a.jsonl", "id string", forbid_extra=True).collect()
    (tmp_path / "b.jsonl").write_text('{"id": "1"}\n{bad\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/b.jsonl", "id string", strict=False).count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_jsonl(spark, f"{tmp_path}/b.jsonl", "id string").collect()
    assert readers.repair_bytes("canción – ".encode() + b"\x97") == "canción – ó"
    assert readers.parse_card("<table><tr><td>A&amp;B</td><td> x  y</td></tr><tr><td>C</td></tr></table>") == {"A&B": "x y", "C": ""}


def test_references_count_once_and_with_their_semicolon(spark):
    texts = ["a &amp;&amp; b", "cut &amp;&amp", "&amp;lt;", "&#x27;&#241;&eacute;", "&lt &notit; &#x27", None]
    want = ["a && b", "cut &&amp", "&lt;", "'ñé", "&lt &notit; &#x27", None]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", readers.html_text("x").alias("x")).collect()
    assert [r["x"] for r in sorted(got)] == want
    for text, plain in zip(texts[:-1], want[:-1], strict=True):
        assert readers.parse_card(f"<table><tr><th>T&iacute;tulo</th><td>{text}</td></tr></table>") == {"Título": plain}


def test_incremental_takes_new_files_only(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for ids in ([1, 2, None], [2, 3, 3, None], []):
        spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.mode("append").parquet(source)
        incremental.append_new(spark, source, "id int", out, f"{tmp_path}/cp", "id")
    got = incremental.appended(spark, "id int", out)
    assert sorted((r["id"] for r in got.collect()), key=str) == [1, 2, 3, None]
    seen = []
    for _ in range(2):
        incremental.run_available(spark, source, "id int", f"{tmp_path}/cp2", lambda batch, number: seen.append(batch.count()))
    assert sum(seen) == 7
