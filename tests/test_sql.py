"""Every SQL function equals its Column, table functions give rows, and tables can be asked by name."""

import pytest
from pyspark.sql import functions as F

from foliant import sql
from foliant.functions import text

TEXTS = ["Guatemala, cuatro de mayo de dos mil diez.", "Expediente No. 61-98: I) confirma", "", None, "it's \\d+ \"quoted\" 'twice' -> (x) AND(y) +(1)", "Se Deniega", "a\fb\f \n", "61-98", " 7-20x ", "ÁÉ ñ日", "Con Lugar -Derecho"]
VALUES = {"STRING": TEXTS, "INT": [1, 5, None], "BIGINT": [0, 3, 10], "ARRAY<STRING>": [["61-98", "x", None], [], None], "MAP<STRING,STRING>": [{"Fallo": "Con Lugar"}, {"Fallo": " "}, None]}


@pytest.mark.parametrize("name", sorted(sql.functions()))
def test_functions_equal_their_columns(spark, name):
    f = sql.functions()[name]
    sql.register(spark)
    kinds = [a.split(" ", 1)[1] for a in sql.re.split(r",\s*(?![^<]*>)", f.arguments)]
    rows = [tuple(VALUES[k][(i + j) % len(VALUES[k])] for j, k in enumerate(kinds)) for i in range(22)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(f.names, kinds, strict=True)))
    df.createOrReplaceTempView("given")
    want = df.select(f.column(*map(F.col, f.names)).alias("v")).collect()
    got = spark.sql(f"SELECT {name}({', '.join(f.names)}) AS v FROM given").collect()
    assert got == want


def test_literals_and_operators_survive():
    c = F.when((F.col("a") == "it's =( and('x')") & ~(F.col("b") - 1 > 2), F.concat("a", F.lit("\\+("))).otherwise(F.lit("'"))
    written = sql.text_of(c)
    assert "and('x" in written or "and(\\'x" in written
    assert "`and`(" in written and "`>`(" in written


def test_awkward_literals(spark):
    c = F.when((F.col("a") == "it's =( and('x')") & ~(F.col("b") - 1 > 2), F.concat("a", F.lit("\\+("))).otherwise(F.lit("'"))
    df = spark.createDataFrame([("it's =( and('x')", 1), ("it's =( and('x')", 9), ("b", 1)], "a string, b int")
    df.createOrReplaceTempView("awkward")
    assert spark.sql(f"SELECT {sql.text_of(c)} AS v FROM awkward").collect() == df.select(c.alias("v")).collect()


def test_table_functions(spark):
    sql.register(spark)
    df = spark.createDataFrame([(1, "a\fb\f "), (2, "one"), (3, "x\f\fy")], "id int, t string")
    sql.views({"texts": df})
    got = spark.sql("SELECT id, page, content FROM texts, LATERAL pages_of(t)").collect()
    want = [(r["id"], i + 1, p) for r in df.select("id", text.split_pages(F.col("t")).alias("p")).collect() for i, p in enumerate(r["p"])]
    assert sorted(map(tuple, got)) == want == [(1, 1, "a"), (1, 2, "b"), (2, 1, "one"), (3, 1, "x"), (3, 2, ""), (3, 3, "y")]
    assert [tuple(r) for r in spark.sql("SELECT * FROM years_of(array('61-98', 'x', '7-1234'))").collect()] == [("61-98", 1998, None), ("x", None, "sin guion"), ("7-1234", None, "fuera del periodo")]


def test_saved_tables_stay_in_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS records LOCATION 'file://{tmp_path}/records'")
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):  # the second time replaces the first
        sql.save({"census": spark.createDataFrame(rows, "id int, kind string")}, "records")
    assert sorted(map(tuple, spark.sql("SELECT * FROM records.census").collect())) == [(2, "b"), (3, "c")]
    spark.sql("DROP DATABASE records CASCADE")
