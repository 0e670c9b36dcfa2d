"""A SQL surface: the tables as views or in a database, and the Columns as SQL functions of the session.

Every function is made from the same definition as its Column: ``text_of`` writes a Column over
named arguments as SQL, and ``CREATE TEMPORARY FUNCTION ... RETURN`` registers it, so a query in SQL has the
plan that the DataFrame would have, with nothing that runs row by row in Python. Table
functions give a text's pages and its case numbers as rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import casenum, dates, rules, stats, text
from foliant.operators import extraction

#: The year as of which case numbers are judged, unless ``register`` is told another.
AS_OF = 2026
_OPERATOR = re.compile(r"(?<![\w`'>])(and|or|not|<=>|>=|<=|<>|!=|==|=|>|<|\+|-|\*|/|%|&|\|)\(")


def text_of(c: Column) -> str:
    """A Column as SQL: operators are written as functions, which the parser takes in back quotes."""
    written = c._jc.node().sql()
    parts = re.split(r"('(?:[^'\\]|\\.|'')*')", written)  # string literals stay as they are
    return "".join(p if p.startswith("'") else _OPERATOR.sub(r"`\1`(", p) for p in parts)


@dataclass(frozen=True)
class Function:
    arguments: str
    column: Callable[..., Column]

    @property
    def names(self) -> list[str]:
        return [a.split()[0] for a in re.split(r",\s*(?![^<]*>)", self.arguments)]


def functions(as_of_year: int = AS_OF) -> dict[str, Function]:
    """The scalar functions by name."""
    f = Function
    return {
        "case_year": f("c STRING", lambda c: casenum.year_number(c, as_of_year)),
        "case_year_problem": f("c STRING", lambda c: casenum.year_of(c, as_of_year)["reason"]),
        "canonical_case": f("c STRING", lambda c: casenum.canonical(c, as_of_year)),
        "case_variants": f("c STRING", casenum.variants),
        "filing_year": f("c STRING", casenum.filing_year),
        "document_years": f("cases ARRAY<STRING>", lambda c: casenum.document_years(c, as_of_year, "each")),
        "first_document_year": f("cases ARRAY<STRING>", lambda c: casenum.document_years(c, as_of_year, "first")),
        "plain_text": f("t STRING", text.plain),
        "squashed": f("t STRING", text.squash),
        "text_pages": f("t STRING", text.split_pages),
        "page_of": f("t STRING, at INT", text.page_of),
        "resolution_date": f("t STRING", dates.resolution_date),
        "outcome_of_sense": f("t STRING", rules.outcome_of_sense),
        "outcome_of_clause": f("t STRING", rules.outcome_of_clause),
        "procedural_effect": f("outcome STRING, kind STRING", rules.procedural_effect),
        "case_in_text": f("t STRING", lambda t: extraction.located(t, extraction.CASE)),
        "court_in_text": f("t STRING", lambda t: extraction.located(t, extraction.COURT)),
        "kind_in_text": f("t STRING", lambda t: extraction.located(t, extraction.HEADING)),
        "of_sense_labels": f("card MAP<STRING,STRING>", lambda c: extraction.of_card(c, *extraction.SENSE_LABELS)),
        "wilson_interval": f("hits BIGINT, n BIGINT", stats.wilson),
    }


def table_functions() -> dict[str, tuple[str, str, str]]:
    """The table functions by name: arguments, columns, and the query behind them."""
    pages = text_of(text.split_pages(F.col("t")))  # a generator takes no SQL function
    return {
        "pages_of": ("t STRING", "page INT, content STRING", f"SELECT p + 1, x FROM posexplode({pages}) AS e(p, x)"),
        "years_of": ("cases ARRAY<STRING>", "case STRING, year INT, problem STRING", "SELECT x, case_year(x), case_year_problem(x) FROM explode(cases) AS e(x)"),
    }


def register(spark: SparkSession, as_of_year: int = AS_OF) -> list[str]:
    """Make the functions known to the session; their names."""
    for name, f in functions(as_of_year).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({f.arguments}) RETURN {text_of(f.column(*map(F.col, f.names)))}")
    for name, (arguments, columns, query) in table_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) RETURN {query}")
    return [*functions(as_of_year), *table_functions()]


def views(tables: dict[str, DataFrame]) -> None:
    """Tables (those of ``evidence.load_model``, say) as views of the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save(tables: dict[str, DataFrame], database: str) -> None:
    """Tables in a database of the session's catalog, each replaced as a whole; the warehouse keeps them."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
