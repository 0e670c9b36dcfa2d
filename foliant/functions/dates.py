"""Numbers and dates in Spanish words, and the dates that a ruling states, as Column expressions.

A date in words is found by one scan for whole dates; day, month and year are then read from
the short matches. Nothing is guessed: a phrase that isn't wholly understood gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.casenum import filing_year
from foliant.functions.text import after, fold, let, squash, strip_accents

# Spanish number words and months.
UNITS = {
    "uno": 1, "primero": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
    "diez": 10, "once": 11, "doce": 12, "trece": 13, "catorce": 14, "quince": 15, "dieciseis": 16, "diecisiete": 17,
    "dieciocho": 18, "diecinueve": 19, "veinte": 20, "veintiuno": 21, "veintiuna": 21, "veintidos": 22, "veintitres": 23,
    "veinticuatro": 24, "veinticinco": 25, "veintiseis": 26, "veintisiete": 27, "veintiocho": 28, "veintinueve": 29, "treinta": 30,
}
TENS = {"treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70, "ochenta": 80, "noventa": 90}
HUNDREDS = {"cien": 100, "ciento": 100, "doscientos": 200, "trescientos": 300, "cuatrocientos": 400, "quinientos": 500, "seiscientos": 600, "setecientos": 700, "ochocientos": 800, "novecientos": 900}
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
VALUES = {**UNITS, **TENS, **HUNDREDS}


def _any(words) -> str:
    return "(?:" + "|".join(words) + ")"


# Which words a year is written with, and the forms of dates in words and in digits.
_NOT_IN_YEARS = {"primero", "veintiuna"}
_BELOW_100 = _any([rf"{_any(TENS)}\s+y\s+{_any([w for w, n in UNITS.items() if n < 10 and w not in _NOT_IN_YEARS])}", *TENS, *[w for w in UNITS if w not in _NOT_IN_YEARS]])
# a word ends where the next one begins, so the order of the alternatives doesn't matter
_YEAR = rf"(?:dos\s+)?mil(?:\s+{_any(HUNDREDS)}\b)?(?:\s+{_BELOW_100}\b)?"
# a look at the first letter saves the costly question whether a word begins here
_INITIALS = "".join(sorted({w[0] for w in UNITS}))
#: "el" may be glued to the day, and "de" to the month's either side.
WORD_DATE = rf"(?iU)(?=[{_INITIALS}])(?:\b|(?<=\bel))(treinta\s+y\s+uno|{_any(UNITS)})\s+de\s+({_any(MONTHS)})\s*,?\s*(?:del?(?:\s+ano)?\s*)?({_YEAR})\b"
NUMERIC_DATE = r"(?U)\b(\d{1,2})[/-](\d{1,2})[/-](\d{4})\b"
# The court's dateline, the filing section and its end, the words of several filings and of filing here.
DATELINE = r"(?iU)CORTE\s+DE\s+CONSTITUCIONALIDAD[^:]{0,200}?:\s*Guatemala\s*,?\s*"
SECTION = r"(?iU)(?=A)\bA\)\s*(?:Interposicion|Solicitud|Presentacion)[^:]{0,60}:"
SECTION_END = r"(?U)\bB\)"
SEVERAL = r"(?iU)\b(?:presentad[oa]s|presentaron|interpusieron|planteadas|respectivamente)\b"
IN_COURT = r"(?iU)\ben\s+esta\s+Corte\b|Corte\s+de\s+Constitucionalidad"
SECTION_REACH, SECTION_LENGTH = 800, 400
FIRST_PLAUSIBLE_YEAR, MOST_YEARS_BEFORE = 1986, 5
STATES = ("revision_humana", "sin_apartado", "varias_acciones", "apartado_sin_fecha", "ok")


def _map(words: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in words.items() for x in kv])


def number_words(c: Column) -> Column:
    """``mil novecientos noventa y ocho`` to 1998; null for blank text or any unknown word."""
    known = _map(VALUES)
    words = F.filter(F.split(squash(F.replace(F.lower(strip_accents(c)), F.lit("-"), F.lit(" "))), " "), lambda w: ~w.isin("y", ""))
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("now"), F.lit(True).alias("ok"))

    def step(acc: Column, w: Column) -> Column:
        value = F.try_element_at(known, w)
        thousand = w == "mil"
        return F.struct(
            F.when(thousand, acc["total"] + F.greatest(acc["now"], F.lit(1)) * 1000).otherwise(acc["total"]).alias("total"),
            F.when(thousand, 0).otherwise(acc["now"] + F.coalesce(value, F.lit(0))).alias("now"),
            (acc["ok"] & (thousand | value.isNotNull())).alias("ok"),
        )

    return let(words, lambda w: F.when(F.size(w) > 0, F.aggregate(w, zero, step, lambda a: F.when(a["ok"], a["total"] + a["now"]))))


def _calendar(day: Column, month: Column, year: Column) -> Column:
    """A date of the years 1000 to 2999, or null if there is no such day."""
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    longest = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.when(year.between(1000, 2999) & month.isNotNull() & day.between(1, longest), F.make_date(year, month, day))


def _day(words: Column) -> Column:
    """The number of a date's day in small letters; its form is known, so one look is enough."""
    return let(words, lambda w: F.when(F.startswith(w, F.lit("treinta")) & (F.length(w) > len("treinta")), 31).otherwise(F.try_element_at(_map(UNITS), w)))


def _year(words: Column) -> Column:
    """The number of a date's year in small letters, of the form of ``_YEAR``: a sum, but for the "dos" before "mil"; null for any unknown word."""
    values = _map({"mil": 1000, "dos": 2, "y": 0, **VALUES})  # a map is read from its start
    total = lambda w: F.aggregate(w, F.lit(0), lambda acc, x: acc + F.try_element_at(values, x))
    return let(F.split(squash(words), " "), lambda w: total(w) + F.when(w[0] == "dos", 998).otherwise(0))


def _first(found: Column, to_date) -> Column:
    """struct(date, at) of the first match that is a date; null without one."""
    none = F.lit(None).cast("struct<date:date,match:string>")
    return F.aggregate(found, none, lambda acc, x: F.when(acc.isNotNull(), acc).otherwise(let(to_date(x), lambda d: F.when(d.isNotNull(), F.struct(d.alias("date"), x.alias("match"))))))


def word_date(c: Column) -> Column:
    """struct(date, quote): the first date in words that exists, quoted as it is spelled; null without one.

    Matches that aren't dates (31 February, a year outside 1000-2999) are passed over.
    """

    def read(match: Column) -> Column:
        small = lambda c: F.lower(strip_accents(c))
        parts = F.split(F.regexp_replace(match, WORD_DATE, "$1|$2|$3"), r"\|")
        return let(parts, lambda p: let(F.struct(_day(small(p[0])).alias("d"), F.try_element_at(_map(MONTHS), F.lower(p[1])).alias("m"), _year(small(p[2])).alias("y")), lambda n: _calendar(n["d"], n["m"], n["y"])))

    def quoted(flat: Column) -> Column:
        first = _first(F.regexp_extract_all(flat, F.lit(WORD_DATE), 0), read)
        return let(first, lambda f: F.when(f.isNotNull(), F.struct(f["date"].alias("date"), squash(F.substring(c, F.instr(flat, f["match"]), F.length(f["match"]))).alias("quote"))))

    return let(fold(c), quoted)


def numeric_date(c: Column) -> Column:
    """struct(date, quote): the first d/m/Y or d-m-Y that exists; null without one."""
    part = lambda x, i: F.regexp_extract(x, NUMERIC_DATE, i).cast("int")
    found = _first(F.regexp_extract_all(c, F.lit(NUMERIC_DATE), 0), lambda x: F.try_to_date(F.format_string("%04d-%02d-%02d", part(x, 3), part(x, 2), part(x, 1)), "yyyy-MM-dd"))
    return let(found, lambda f: F.when(f.isNotNull(), F.struct(f["date"].alias("date"), f["match"].alias("quote"))))


def any_date(c: Column) -> Column:
    """In words if there is one, else in digits."""
    return F.coalesce(word_date(c), numeric_date(c))


def resolution_date(c: Column) -> Column:
    """struct(date, quote, anchored): the first word date after the court's dateline; else the text's first date, not anchored; null without any."""
    shaped = lambda d, anchored: let(d, lambda x: F.when(x.isNotNull(), F.struct(x["date"].alias("date"), x["quote"].alias("quote"), F.lit(anchored).alias("anchored"))))
    # one character of the dateline stays, so that a glued word doesn't look like the beginning of a word
    behind = let(after(c, fold(c), DATELINE), lambda rest: F.when(rest.isNotNull(), F.right(c, F.length(rest) + 1)))
    return F.coalesce(shaped(word_date(behind), True), shaped(any_date(c), False))


def filing(c: Column) -> Column:
    """struct(section, date, quote, several, in_court) of the filing section "A) Interposición ...:"; null if there is none.

    It ends at "B)", or after 400 characters. Of several filings none is chosen. Only dates in
    words count: the first date elsewhere in a ruling is another fact.
    """

    def read(section: Column) -> Column:
        several = section.rlike(SEVERAL)
        d = F.when(~several, word_date(section))
        return let(d, lambda x: F.when(section.isNotNull(), F.struct(section.alias("section"), x["date"].alias("date"), x["quote"].alias("quote"), several.alias("several"), section.rlike(IN_COURT).alias("in_court"))))

    def section_of(text: Column) -> Column:
        def cut(rest: Column) -> Column:
            window = F.substring(rest, 1, SECTION_REACH)
            ended = F.when(window.rlike(SECTION_END), F.regexp_extract(window, rf"(?s)\A(.*?){SECTION_END}", 1))
            return F.trim(F.coalesce(ended, F.substring(rest, 1, SECTION_LENGTH)))

        return let(after(text, fold(text), SECTION), cut)

    return let(let(squash(c), section_of), read)


def filing_alerts(filed: Column, resolved: Column, case: Column) -> Column:
    """Ordered list of what is implausible about a filing date; it is flagged, never corrected."""
    y, of = F.year(filed), filing_year(case)
    rules = [
        F.when(y < FIRST_PLAUSIBLE_YEAR, F.lit("anio_de_presentacion_imposible")),
        F.when(filed > resolved, F.lit("presentacion_posterior_a_la_resolucion")),
        F.when(y > of, F.lit("presentacion_posterior_al_anio_del_expediente")),
        F.when(of - y > MOST_YEARS_BEFORE, F.lit(f"presentacion_mas_de_{MOST_YEARS_BEFORE}_anios_antes_del_expediente")),
    ]
    return F.array_compact(F.array(*rules))


def filing_state(filing_: Column, usable: Column) -> Column:
    """One of ``STATES``; an unusable text isn't read at all."""
    return (
        F.when(~F.coalesce(usable, F.lit(False)), "revision_humana").when(filing_.isNull(), "sin_apartado").when(filing_["several"], "varias_acciones").when(filing_["date"].isNull(), "apartado_sin_fecha").otherwise("ok")
    )


def filing_record(text: Column, usable: Column, portal_date: Column, case: Column) -> Column:
    """All that a text says about its filing: struct(state, filed, quote, alerts, section, in_court, resolved, anchored, note).

    Alerts compare with the date of the ruling: the text's if it is anchored to the dateline, else
    the portal's. A text's date that differs from the portal's is noted; neither is corrected.
    """
    none = lambda kind: F.lit(None).cast(kind)

    def read(x: Column) -> Column:
        f, r = x["f"], x["r"]
        state = filing_state(f, usable)
        dated = (state == "ok") | (state == "varias_acciones") | (state == "apartado_sin_fecha")
        reference = F.coalesce(F.when(r["anchored"], r["date"]), portal_date)
        known = F.coalesce(usable, F.lit(False))
        return F.struct(
            state.alias("state"), F.when(state == "ok", f["date"]).alias("filed"), F.when(state == "ok", f["quote"]).alias("quote"),
            F.when(state == "ok", filing_alerts(f["date"], reference, case)).alias("alerts"), F.when(dated, F.substring(f["section"], 1, 400)).alias("section"),
            F.when(dated, f["in_court"]).alias("in_court"), F.when(known, r["date"]).alias("resolved"), F.when(known, r["anchored"]).alias("anchored"),
            F.when(known & (r["date"] != portal_date), F.lit("la fecha del encabezado difiere de la del portal")).otherwise(none("string")).alias("note"),
        )

    return let(F.struct(F.when(usable, filing(text)).alias("f"), F.when(usable, resolution_date(text)).alias("r")), read)
