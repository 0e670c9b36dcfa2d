"""The commands, on small tables and with a transport of their own."""

import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from foliant import __main__ as cli
from foliant.operators import study
from foliant.sources import remote
from tests.test_sources import transport


def asked(method, url, body, headers):
    return remote.Response(404, b"") if url.endswith("robots.txt") else transport(method, url, body, headers)


@pytest.fixture
def run(spark, tmp_path):
    def go(name, *options, **tables):
        argv = [name, *options]
        for option, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}-{option}")
            argv += [f"--{option.replace('_', '-')}", f"{tmp_path}/{name}-{option}"]
        return cli.main(argv, spark)

    return go


NET = ("--transport", "tests.test_commands:asked", "--per-second", "100000")


def test_offline_commands(spark, run, tmp_path):
    out = ("--out", f"{tmp_path}/out")
    c = spark.createDataFrame([("1", ["300-2015"], "A", "x", 1)], "id string, cases array<string>, kind string, decided string, ord int")
    assert run("census", "--as-of", "2026", table=c)["by_year"] == {"2015": 1}
    assert run("sample", *out, table=spark.range(30).select("id", F.lit(2010).alias("stratum")))["sampled"] == 28
    texts = spark.createDataFrame([("1", "A) Solicitud: presentado el uno de mayo de dos mil, en esta Corte. B) x", True, date(2001, 1, 1), "1-00")], "id string, text string, usable boolean, portal date, case string")
    assert run("filings", *out, table=texts) == {"rows": 1}
    assert spark.read.parquet(f"{tmp_path}/out").first()["state"] == "ok"
    rulings = spark.createDataFrame([("1", "POR TANTO: I) Confirma la sentencia.", "p")], "id string, text string, period string")
    assert run("study-appeals", *out, table=rulings) == {"rows": 1}
    decided = spark.read.parquet(f"{tmp_path}/out")
    assert run("rates", "--out", f"{tmp_path}/rates", table=decided) == {"rows": 2}
    ids = spark.createDataFrame([("1", "61-98", "61-1998", "1")], "id string, case string, forward_case string, reverse_id string")
    assert run("check-ids", *out, table=ids) == {"rows": 1}
    (tmp_path / "f.bin").write_bytes(b"x")
    manifest = spark.createDataFrame([(f"file:{tmp_path}/f.bin", hashlib.sha256(b"x").hexdigest()), ("file:/none", "y")], "path string, sha256 string")
    assert run("verify", "--files", f"{tmp_path}/*.bin", table=manifest) == {"ok": 1, "falta": 1}
    cards = spark.createDataFrame([("1", "EXPEDIENTE 1-2000", {"Fallo": "Con lugar"})], "id string, text string, card map<string,string>")
    assert run("extract", *out, table=cards) == {"rows": 1}


def test_review_and_validation(spark, run, tmp_path):
    decisions = spark.createDataFrame([(str(i), ["1-98"], 1998, "mantiene", "confirma", "p") for i in range(5)], "id string, cases array<string>, year int, effect string, rule string, point string")
    run("review", "--out", f"{tmp_path}/sheet", table=decisions, census_table=spark.createDataFrame([("1", "http://h/x.pdf")], "id string, pdf string"))
    sheet = spark.read.option("header", True).csv(f"{tmp_path}/sheet")
    assert sheet.columns == list(study.SHEET) and sheet.count() == 5
    reviewed = sheet.withColumn(study.HUMAN_COLUMNS[1], F.when(F.col("n") == "1", "altera").when(F.col("n") != "5", "mantiene"))
    reviewed.coalesce(1).write.option("header", True).csv(f"{tmp_path}/back")
    sizes = spark.createDataFrame([("mantiene", 10)], "stratum string, size int")
    sizes.write.parquet(f"{tmp_path}/sizes")
    got = cli.main(["validate", "--table", f"{tmp_path}/back", "--sizes", f"{tmp_path}/sizes"], spark)
    assert (got["n"], got["k"], got["weighted"], got["unreviewed"], got["verdict"]) == (4, 3, 0.75, 1, "insuficiente")


def test_commands_with_a_transport(spark, run, tmp_path):
    assert run("probe", *NET, "--url", "http://h.test/api", "--query", "amparo") == {"robots_status": 404, "robots_sha256": hashlib.sha256(b"").hexdigest(), "delay": None, "rows": 1, "total": 6, "outcome": "ok", "note": None}
    assert run("discover", *NET, "--url", "http://h.test/api", "--query", "amparo", "--limit", "3", "--out", f"{tmp_path}/d.jsonl") == {"records": 3}
    wanted = spark.createDataFrame([(1, "http://h.test/1.pdf", 2000)], "id long, pdf string, year int")
    for n in (1, 0):  # the second run has nothing left to do
        assert run("attributes", *NET, "--card-url", "http://h.test/card", "--out", f"{tmp_path}/a.jsonl", table=wanted) == {"records": n}
        assert run("pdfs", *NET, "--root", str(tmp_path), "--out", f"{tmp_path}/p.jsonl", table=wanted) == {"records": n}
    assert json.loads((tmp_path / "p.jsonl").read_text())["outcome"] == "ok"


def test_search_graph_and_versions(spark, run, tmp_path):
    out, rows = f"{tmp_path}/result", lambda: sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/result").collect())
    texts = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string")
    assert run("index-texts", "--index", f"{tmp_path}/ft", table=texts((1, "uno dos tres")))["documents"] == 1
    assert run("index-texts", "--index", f"{tmp_path}/ft", table=texts((2, "dos tres cuatro"))) == {"documents": 2, "words": 4}
    asked = spark.createDataFrame([(1, "tres cuatro")], "query long, text string")
    run("search-texts", "--index", f"{tmp_path}/ft", "--out", out, table=asked)
    assert [r[2] for r in rows()] == [2, 1]
    run("find-phrases", "--index", f"{tmp_path}/ft", "--out", out, table=asked)
    assert rows() == [(1, 2, 1)]
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(8)], "vec_id long, embedding array<double>")
    assert run("index-vectors", "--index", f"{tmp_path}/v", "--dims", "2", table=v)["vectors"] == 8
    assert run("index-vectors", "--index", f"{tmp_path}/v", "--dims", "2", table=v.select(F.col("vec_id") + 8, "embedding").toDF("vec_id", "embedding"))["vectors"] == 16
    assert run("near-vectors", "--index", f"{tmp_path}/v", "--out", out, table=v.limit(1))["rows"] >= 1
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    run("weigh", "--out", out, table=edges)
    assert [round(r[1], 6) for r in rows()] == [0.333333] * 3
    run("reach", "--out", out, table=edges, seeds=spark.createDataFrame([(2,)], "id long"))
    assert rows() == [(1, 2), (2, 0), (3, 1)]
    run("groups", "--strong", "case", "--weak", "day", "--out", out, table=spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "x")], "id long, case string, day string"))
    assert [(r[0], r[1], r[4]) for r in rows()] == [(1, 1, 1), (2, 1, 1), (3, 3, 1)]
    assert run("record", "--base", f"file://{tmp_path}/versions", "--key", "doc_id", "--source", "portal", table=texts((1, "a"), (2, "b"))) == {"run": 1, "source": "portal", "new": 2}
    assert run("record", "--base", f"file://{tmp_path}/versions", "--key", "doc_id", "--source", "portal", table=texts((1, "A"))) == {"run": 2, "source": "portal", "changed": 1, "vanished": 1}
    texts((5, "61-98")).write.parquet(f"{tmp_path}/cases")
    assert run("ask", "--table", f"{tmp_path}/cases", "--sql", "SELECT canonical_case(text) AS c FROM cases") == {"rows": [{"c": "61-1998"}]}
