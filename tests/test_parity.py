"""ISO forms against Python's own parser, quotes by their rarest word, load model with repeated ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliant.functions import casenum
from foliant.operators import discovery, evidence

ISO = """2020-01-01|20200101|2020-W01-1|2020W011|2020-W01|2020W53|2020-W53-7|2021-W53-1|2020-W00-1|2020-W54|2020-01-01T10|2020-01-01T10:05|2020-01-01T1005|20200101T100530|2020-01-01 10:05:06.5|2020-01-01T10:05:06,123456789
2020-01-01T10:05:06+0000|2020-01-01T10:05:06+05|2020-01-01T10:05:06-05:30|2020-01-01T10:05:06Z|20200101T10Z|2020-01-01x10:05|2020-02-30|20200230|2020-13-01|2020-01-01T25:00|2020-01-01T10:60|2020-1-1|2020-01-01T|2020-01-01T1|2020-01-01T10:5|202001|2020|x|2020-01-01T10:05:06.|2020-W01-8|2020-W01-0
2024-02-29|2023-02-29|1999-12-31T23:59:59.999999+01:15:30|2020-0101|202001-01|2020-01-01T10:0530|2009-W53-7|2010-W53-1|2026-W01-1|2020-01-01T10:05:06+00:0""".replace("\n", "|").split("|")


def python_says(text):
    try:
        t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None, None
    return t.date(), (t if t.tzinfo else t.replace(tzinfo=dt.UTC)).astimezone(dt.UTC).replace(tzinfo=None)


def test_iso_forms(spark):
    df = spark.createDataFrame([(t,) for t in [*ISO, "", None]], "t string")
    got = df.select("t", discovery.iso_date(F.col("t"), "f").alias("d"), discovery.iso_time(F.col("t"), "f").alias("m")).collect()
    for r in got:
        day, time = python_says(r["t"]) if r["t"] else (None, None)
        assert (r["d"]["value"], r["m"]["value"]) == (day, time), r["t"]
        assert (r["d"]["warning"] is None) == (r["m"]["warning"] is None) == (day is not None or not r["t"]), r["t"]


def test_quotes_meet_by_their_rarest_word(spark):
    docs = [(i, f"la considerablemente sentencia numero n{i} fue dictada hoy") for i in range(40)] + [(100, ""), (101, None), (102, "uno dos")]
    quotes = [(1, "considerablemente sentencia numero n7 fue"), (2, "la considerablemente sentencia"), (3, "considerablemente ausente aqui mismo"), (4, "dos"), (5, "ntencia num"), (6, ""), (7, None), (8, "dictada hoy"), (9, "no esta")]
    got = {(r["d"], r["q"]) for r in evidence.quotes_in(spark.createDataFrame(docs, "d long, text string"), spark.createDataFrame(quotes, "q long, text string"), "d", "q").collect()}
    assert got == {(d, q) for d, t in docs for q, s in quotes if t and s and s in t}


def test_years_and_canonical_numbers(spark):
    cases = ["5577-2015", "61-98", " 61 - 98 ", "1-80", "1-79", "7-2028", "7-1985", "7-", "7", "", None, "7-20x", "7-+5", "7-198", "a-b-2001", "7-0099", "7- 2001", "7-99999999999"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r["c"]: (r["y"], r["r"], r["n"], r["k"]) for r in df.select("c", casenum.year_of(F.col("c"), 2026)["year"].alias("y"), casenum.year_of(F.col("c"), 2026)["reason"].alias("r"), casenum.year_number(F.col("c"), 2026).alias("n"), casenum.canonical(F.col("c"), 2026).alias("k")).collect()}
    want = {
        "5577-2015": (2015, None, "5577-2015"), "61-98": (1998, None, "61-1998"), " 61 - 98 ": (1998, None, "61 -1998"), "1-80": (None, "fuera del periodo", "1-80"), "1-79": (None, "fuera del periodo", "1-79"),
        "7-2028": (None, "fuera del periodo", "7-2028"), "7-1985": (None, "fuera del periodo", "7-1985"), "7-": (None, "no numerico", "7-"), "7": (None, "sin guion", "7"), "": (None, "sin guion", ""), None: (None, "sin guion", None),
        "7-20x": (None, "no numerico", "7-20x"), "7-+5": (None, "no numerico", "7-+5"), "7-198": (None, "longitud del anio", "7-198"), "a-b-2001": (2001, None, "a-2001"), "7-0099": (None, "fuera del periodo", "7-0099"), "7- 2001": (2001, None, "7-2001"), "7-99999999999": (None, "longitud del anio", "7-99999999999"),
    }
    assert got == {c: (y, r, y, k) for c, (y, r, k) in want.items()}


@pytest.mark.parametrize("flip", [False, True])
def test_load_model_chooses_one_kind(spark, flip):
    rows = [("a", "amparo"), ("a", "zeta"), ("b", None)]
    census = spark.createDataFrame(rows[::-1] if flip else rows, "id string, kind string")
    decisions = spark.createDataFrame([("a", "altera"), ("b", "mantiene"), ("c", None)], "id string, effect string")
    cards = spark.createDataFrame([], "id string, attributes map<string,string>")
    docs, facts = spark.createDataFrame([], "id string"), spark.createDataFrame([], "id string, value string")
    tables = evidence.load_model(census, cards, decisions, docs, facts)
    assert {(r["id"], r["kind"]) for r in tables["decisions"].collect()} == {("a", "amparo"), ("b", None)}


def test_variants(spark):
    forms = {"61-98": ["61-98", "61-1998"], "61-1998": ["61-1998", "61-98"], " 7-05 ": ["7-05", "7-2005"], "4492": ["4492"], "7-1850": ["7-1850"], "a-98": ["a-98"], "1-2-98": ["1-2-98"], "7-00": ["7-00", "7-2000"], "7-79": ["7-79", "7-2079"], "": [""]}
    df = spark.createDataFrame([(c,) for c in forms], "c string")
    assert {r["c"]: r["v"] for r in df.select("c", casenum.variants(F.col("c")).alias("v")).collect()} == forms


@pytest.mark.parametrize("hot", [10_000, 1])
def test_officers_out_of_office(spark, hot, monkeypatch):
    from foliant.operators import indicators, store

    monkeypatch.setattr(store, "HOT_ROWS", hot)
    d = dt.date
    decisions = [(1, "cc", d(2010, 5, 1), ["Ana", "Luis", "Ana"]), (2, "cc", d(2012, 1, 1), ["Ana", "Eva", None]), (3, None, d(2010, 1, 1), ["Ana"]), (4, "cc", None, ["Luis"]), (5, "cc", d(2010, 1, 1), []), (6, "csj", d(2030, 1, 1), ["Luis", "Ana"]), (7, "cc", d(2011, 12, 31), ["Ana"])]
    terms = [("Ana", "cc", d(2010, 1, 1), d(2011, 12, 31)), ("Luis", "cc", d(2009, 1, 1), d(2010, 4, 30)), ("Luis", "csj", d(2011, 1, 1), None), (None, "cc", d(2000, 1, 1), None)]
    df = spark.createDataFrame(decisions, "id long, court string, decided date, signers array<string>")
    ts = spark.createDataFrame(terms, "name string, court string, since date, until date")
    got = {r["id"]: (r["incompatible"], r["unknown"]) for r in indicators.out_of_office(df, ts, "id", "court", "decided", "signers").collect()}
    assert got == {1: (["Luis"], []), 2: (["Ana"], ["Eva"]), 3: ([], ["Ana"]), 4: ([], ["Luis"]), 6: (["Ana"], []), 7: ([], [])}


def test_stamp(spark, tmp_path):
    from foliant.operators import tables

    df = spark.createDataFrame([(1, 5), (2, None)], "id long, used int")
    row = tables.stamped(df, "r1", {"extractor": "3"}, ("abc", True), F.col("used")).orderBy("id").collect()
    assert [tuple(r)[2:] for r in row] == [("r1", "3", "abc", True, 5, None), ("r1", "3", "abc", True, None, None)]
    assert tables.repository_state(str(tmp_path)) == (None, None)
