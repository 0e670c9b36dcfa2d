"""Who signed: officers, their terms, and their names in the signature block of a ruling.

A text layer splits words and interleaves columns, so no names are read: known officers are
looked for among the letters of the block, and only those in office on the day.
"""

from __future__ import annotations

import datetime as dt
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import letters, signature_block

#: A register of officers beyond this isn't one that can be sent to every task.
MOST_TERMS = 10_000
# Particles of names, first year of the five-year terms and their day of change, and the years that a term runs on.
PARTICLES = ("DE", "LA", "LOS", "DEL", "Y")
FIRST_TERM, TERM_YEARS, CHANGE_MONTH, CHANGE_DAY, GRACE_YEARS = 1986, 5, 4, 14, 1
# Compact spellings that signatures have besides the register's.
SPELLINGS = {
    "Carmen María Gutiérrez Solé de Colmenares": ("GUTIERREZDECOLMENARES",),
    "Concha Mazariegos Tobías": ("CONCHITAMAZARIEGOS",),
    "Gloria Evangelina Melgar Rojas de Aguilar": ("MELGARDEAGUILAR",),
    "Fernando José Quedada Toruño": ("QUEZADATORUNO",),
    "Ronán Arnoldo Roca Menénez": ("ROCAMENENDEZ",),
    "Héctor Horacio Zachrissom Descamps": ("ZACHRISSONDESCAMPS",),
    "María de los Ángeles Araujo": ("ARAUJOBOHR",),
}
PERSON = "ord int, name string, keys array<string>, loose array<string>, terms array<struct<first_day:date,last_day:date>>"


def term_day(year: int, end: bool) -> dt.date:
    """First or last day of a term that begins or ends in ``year``: the day of change in years of change, else the year's own."""
    if (year - FIRST_TERM) % TERM_YEARS == 0:
        change = dt.date(year, CHANGE_MONTH, CHANGE_DAY)
        return change - dt.timedelta(days=1) if end else change
    return dt.date(year, 12, 31) if end else dt.date(year, 1, 1)


def _letters(text: str) -> str:
    return re.sub("[^A-Z]", "", unicodedata.normalize("NFD", text.upper()))


def people(officers: DataFrame, spellings: dict[str, tuple[str, ...]] | None = None, grace_years: int = GRACE_YEARS) -> DataFrame:
    """One row per person: place in the register, name, compact keys, loose tokens (first name and both surnames), terms.

    ``officers (name, since, until, ord)``; in order of ``ord``, a row joins the first person
    whose keys hold its own (both surnames) or one of its spellings. That order decides, so the
    merge isn't a grouping; the register is small by nature, which is checked.
    """
    spellings = SPELLINGS if spellings is None else spellings
    rows = officers.select("name", "since", "until", "ord").orderBy("ord", "name", "since", "until").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    merged: list[dict] = []
    for row in rows:
        tokens = [t for t in map(_letters, row["name"].split()) if t and t not in PARTICLES]
        if len(tokens) < 2:
            raise ValueError(f"a name without two tokens: {row['name']!r}")
        key, more = tokens[-2] + tokens[-1], spellings.get(row["name"], ())
        person = next((p for p in merged if key in p["keys"] or set(more) & set(p["keys"])), None)
        if person is None:
            person = {"ord": len(merged), "name": row["name"], "keys": [], "loose": [tokens[0], *tokens[-2:]], "terms": []}
            merged.append(person)
        person["keys"] = list(dict.fromkeys((*person["keys"], key, *more)))
        person["terms"].append((term_day(row["since"], False), term_day(row["until"] + grace_years, True)))
    return officers.sparkSession.createDataFrame([tuple(p.values()) for p in merged], PERSON)


def signers(documents: DataFrame, persons: DataFrame, text: str = "text", decided: str = "decided") -> DataFrame:
    """``documents`` with ``signers``: names, in the register's order, of the persons in office on the day who are in the signature block.

    Either one of a person's keys is in the block's letters, or all three loose tokens are. A
    document without any, without a date or without a text has an empty list. Each document
    meets the persons of its own year only, as one broadcast row of at most ``MOST_TERMS``
    persons; documents aren't shuffled.
    """
    by_year = persons.select(F.explode(F.array_distinct(F.flatten(F.transform("terms", lambda t: F.sequence(F.year(t["first_day"]), F.year(t["last_day"])))))).alias("__year"), F.struct(*persons.columns).alias("p"))
    by_year = by_year.groupBy("__year").agg(F.array_sort(F.collect_list("p")).alias("__people"))
    d = documents.withColumns({"__block": letters(signature_block(F.col(text))), "__year": F.year(decided)}).join(F.broadcast(by_year), "__year", "left")
    block, day = F.col("__block"), F.to_date(decided)
    named = lambda p: F.exists(p["keys"], lambda k: F.contains(block, k)) | F.forall(p["loose"], lambda t: F.contains(block, t))
    found = F.filter("__people", lambda p: F.exists(p["terms"], lambda t: day.between(t["first_day"], t["last_day"])) & named(p))
    names = F.coalesce(F.transform(found, lambda p: p["name"]), F.array().cast("array<string>"))
    return d.select(*documents.columns, names.alias("signers"))


def in_office(persons: DataFrame, day: Column) -> DataFrame:
    """(name) of the persons in office on a day."""
    return persons.where(F.exists("terms", lambda t: day.between(t["first_day"], t["last_day"]))).select("name")
