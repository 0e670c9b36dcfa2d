import unicodedata
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.functions import casenum, dates, rules, ruling, stats, text, textquality


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("case", "year", "reason"),
    [("5577-2015", 2015, None), ("61-98", 1998, None), ("11-87", 1987, None), ("1670-2001 ", 2001, None), (" 61-98 ", 1998, None), ("1-86", 1986, None), ("1-00", 2000, None), ("196-69", None, "fuera del periodo"), ("1298-200", None, "longitud del anio"), ("1014-1996a", None, "no numerico"), ("singuion", None, "sin guion"), (None, None, "sin guion")],
)
def test_year_of(spark, case, year, reason):
    assert tuple(one(spark, lambda c: casenum.year_of(c, 2026), case)) == (year, reason)


@pytest.mark.parametrize(("case", "year"), [("5187-2016", 2016), ("293-98", 1998), ("12-05", 2005), ("sin año", None)])
def test_filing_year(spark, case, year):
    assert one(spark, casenum.filing_year, case) == year


def test_variants(spark):
    assert set(one(spark, casenum.variants, "61-1998")) == {"61-1998", "61-98"}
    assert one(spark, lambda c: casenum.canonical(c, 2026), "1483-96") == "1483-1996"


@pytest.mark.parametrize(("words", "n"), [("dos mil trece", 2013), ("mil novecientos noventa y ocho", 1998), ("treinta y uno", 31), ("veintitrés", 23), ("primero", 1), ("aproximadamente dos mil", None), ("", None)])
def test_number_words(spark, words, n):
    assert one(spark, dates.number_words, words) == n


@pytest.mark.parametrize(
    ("phrase", "day"),
    [("el tres de marzo de dos mil uno", date(2001, 3, 3)), ("treinta y uno de diciembrede mil novecientos noventa y cinco", date(1995, 12, 31)), ("treinta y uno de febrero de dos mil uno", None), ("uno de enero del año dos mil", date(2000, 1, 1)), ("treinta y uno de febrero de dos mil uno, luego dos de julio de dos mil dos", date(2002, 7, 2)), ("año en curso", None)],
)
def test_word_date(spark, phrase, day):
    got = one(spark, dates.word_date, phrase)
    assert (got and got["date"]) == day


def test_numeric_date_takes_the_first_valid(spark):
    assert tuple(one(spark, dates.numeric_date, "31/02/2004 y 1/3/2004")) == (date(2004, 3, 1), "1/3/2004")
    assert one(spark, dates.any_date, "1/3/2004, uno de mayo de dos mil")["date"] == date(2000, 5, 1)


def test_resolution_date_is_anchored_at_the_dateline(spark):
    r = one(spark, dates.resolution_date, "Vista del uno de enero de dos mil. CORTE DE CONSTITUCIONALIDAD: Guatemala, dos de mayo de dos mil tres.")
    assert (r["date"], r["anchored"]) == (date(2003, 5, 2), True)
    r = one(spark, dates.resolution_date, "Sin encabezado, dos de mayo de dos mil tres.")
    assert (r["date"], r["anchored"]) == (date(2003, 5, 2), False)


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="aáeéñÑü ZxÁ\n-řůŁøỆẞάйЁ\u0301\u030cक़", max_size=40))
def test_fold_keeps_lengths_and_strip_is_nfd(spark, s):
    r = spark.createDataFrame([(s,)], "c string").select(text.fold(F.col("c")), text.strip_accents(F.col("c"))).first()
    assert len(r[0]) == len(s)
    assert r[1] == "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def test_pages_and_offsets(spark):
    pages = one(spark, text.split_pages, "one\ftwo\f ")
    assert pages == ["one", "two"]
    marked = "===PAGINA 1===\nab\n===PAGINA 2===\ncd"
    assert one(spark, lambda c: text.page_of(c, F.instr(c, "cd")), marked) == 2
    assert [tuple(x) for x in one(spark, lambda c: text.match_offsets(c, "a+"), "baab a")] == [(2, 4), (6, 7)]


@pytest.mark.parametrize(
    ("sentence", "effect", "rule"),
    [("POR TANTO: I) Confirma con modificación la sentencia.", "altera", "modifica"), ("resuelve: I) Revoca la sentencia.", "altera", "revoca"), ("POR TANTO resuelve: I) Sin lugar los recursos de apelación.", "mantiene", "sin lugar la apelacion"), ("nada", "no_hallado", None), (None, "no_hallado", None)],
)
def test_read_ruling(spark, sentence, effect, rule):
    r = one(spark, ruling.read_ruling, sentence)
    assert (r["effect"], r["rule"]) == (effect, rule)


def test_outcomes(spark):
    assert one(spark, rules.outcome_of_sense, "Con Lugar -Derecho de Propiedad") == "con_lugar"
    assert one(spark, rules.outcome_of_clause, "por notoriamente improcedente, deniega") == "rechazado"
    assert one(spark, lambda c: rules.procedural_effect(c, F.lit("Apelación de Sentencia")), "confirmado") == "mantiene_decision_inferior"
    assert one(spark, lambda c: rules.procedural_effect(c, F.lit("Única instancia")), "confirmado") is None


@pytest.mark.parametrize(("name", "label"), [("Ministerio Público", "Ministerio Público"), ("Banco X, Sociedad Anónima", "Empresa"), ("Sindicato de Trabajadores", "Sindicato"), ("Juan Pérez", "Persona u otro (residual)"), ("  ", "Vacío"), (None, "Vacío")])
def test_petitioner_classes(spark, name, label):
    assert one(spark, rules.PETITIONERS.classify, name)["label"] == label


def test_petitioner(spark):
    assert one(spark, rules.petitioner, "Amparo promovido por Ana Ruiz, por medio de su abogado, contra el Juez.") == "Ana Ruiz"
    r = spark.range(1).select(rules.controlled_verdict(F.lit("no_aplica"), F.lit("altera")).alias("a"), rules.controlled_verdict(F.lit(""), F.lit("Sin lugar y mantiene.")).alias("b"), rules.controlled_verdict(F.lit(""), F.lit("")).alias("c")).first()
    assert tuple(r) == ("otro", "mantiene", None)


def test_own_vote(spark):
    r = one(spark, rules.own_vote, "voto disidente de la sala. POR TANTO: resuelve: confirma. Voto razonado del magistrado.")
    assert tuple(r) == (True, False, 2)


def test_statistics(spark):
    r = spark.createDataFrame([(177, 497), (0, 0)], "k int, n int").select(stats.wilson(F.col("k"), F.col("n")).alias("w")).collect()
    assert round(r[0]["w"]["low"], 4) == 0.3153
    assert tuple(r[1]["w"]) == (0.0, 0.0, 0.0)
    sizes = spark.createDataFrame([(1_000_000,), (613,), (3293,), (10,), (0,), (500,)], "n long").select(stats.cochran(F.col("n")).alias("s")).collect()
    assert [x["s"] for x in sizes] == [385, 237, 345, 10, 0, 218]
    p = spark.range(1).select(stats.chi_square_p(F.lit(10), F.lit(20), F.lit(20), F.lit(10)).alias("p"), stats.chi_square_p(F.lit(0), F.lit(0), F.lit(2), F.lit(1)).alias("q")).first()
    assert round(p["p"], 5) == 0.00982
    assert p["q"] == 1.0


SANE = "el magistrado de la corte que conoce del recurso de amparo y los hechos que se le imputan por el juez en la sentencia breve y valida " * 12


@pytest.mark.parametrize(("page", "verdict"), [(SANE, "usable"), (SANE.replace("m", "").replace("g", ""), "sospechoso"), ("", "sin_capa_de_texto"), (None, "sin_capa_de_texto"), ("1\n\f2", "sin_capa_de_texto"), ("palabra " * 200, "sospechoso")])
def test_text_quality(spark, page, verdict):
    df = spark.createDataFrame([(page,)], "c string")
    assert textquality.assess(df, "c").first()["quality"]["verdict"] == verdict


def test_date_words_as_number_words(spark):
    """The short ways to a date's day and year read every form as ``number_words`` does, and no other word."""
    below = ["", *dates.UNITS, *dates.TENS, *[f"{t} y {u}" for t in dates.TENS for u in ("uno", "seis", "nueve")]]
    years = [" ".join(x for x in (mil, h, b) if x) for mil in ("mil", "dos  mil") for h in ("", *dates.HUNDREDS) for b in below] + ["mil ſeis"]
    y = spark.createDataFrame([(x,) for x in years], "w string").select("w", dates._year(F.col("w")).alias("got"), dates.number_words(F.col("w")).alias("want"))
    assert y.where("not got <=> want").collect() == []
    d = spark.createDataFrame([(x,) for x in (*dates.UNITS, "treinta y uno", "ſeis")], "w string").select("w", dates._day(F.col("w")).alias("got"), dates.number_words(F.col("w")).alias("want"))
    assert d.where("not got <=> want").collect() == []


def test_calendar(spark):
    """Days that exist, and null for others, as the engine's own reading has them; a year outside 1000 to 2999 is none."""
    rows = [(y, m, d) for y in (999, 1000, 1900, 1999, 2000, 2023, 2024, 2999, 3000) for m in (*range(1, 13), None) for d in (1, 28, 29, 30, 31, 32, None)]
    got = spark.createDataFrame(rows, "y int, m int, d int").select("*", dates._calendar(F.col("d"), F.col("m"), F.col("y")).alias("got"))
    want = F.when(F.col("y").between(1000, 2999), F.expr("try_to_date(format_string('%04d-%02d-%02d', y, m, d), 'yyyy-MM-dd')"))
    assert got.where(~F.col("got").eqNullSafe(want)).collect() == []


def test_dates_are_taken_apart_once(spark):
    """The pattern of a date stands in the plan a few times, not once for every use of every part (44 times before)."""
    plan = spark.createDataFrame([("x",)], "t string").select(dates.word_date(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count(dates.WORD_DATE) <= 4


def test_squash_and_after(spark):
    texts = ["", " ", "a b", " a  b\\n", "\\n\\n", "a\\tb \\u00a0c", "a\\x1cb", "x A B A y", "xA", "😀 A \\nz"]
    d = spark.createDataFrame([(x.encode().decode("unicode_escape") if "\\\\" in x else x,) for x in texts], "t string")
    rows = d.select("t", text.squash(F.col("t")).alias("s"), text.after(F.col("t"), F.col("t"), "A").alias("a")).collect()
    assert [r["s"] for r in rows] == [" ".join(r["t"].split()) for r in rows]
    assert [r["a"] for r in rows] == [r["t"].partition("A")[2] if "A" in r["t"] else None for r in rows]
