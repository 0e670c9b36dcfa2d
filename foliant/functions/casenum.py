"""Case numbers such as ``5577-2015`` or ``61-98``: years, variants, and the ways to assign a document to a year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_YEAR, CENTURY_PIVOT, FILING_PIVOT = 1986, 80, 50


def _tail(c: Column) -> Column:
    """What stands after the last hyphen."""
    return F.trim(F.substring_index(F.trim(c), "-", -1))


def _digits(tail: Column) -> Column:
    """Whether a text that isn't empty has digits only; cheaper than a pattern."""
    return F.translate(tail, "0123456789", "") == ""


def _written_year(tail: Column) -> Column:
    """The year that four digits, or two with their century, name; null for anything else."""
    n = tail.try_cast("int")
    return F.when((F.length(tail) == 4) & _digits(tail), n).when((F.length(tail) == 2) & _digits(tail), n + F.when(n >= CENTURY_PIVOT, 1900).otherwise(2000))


def year_number(c: Column, as_of_year: int) -> Column:
    """The year of ``year_of`` alone."""
    n = _written_year(_tail(c))
    return F.when(F.contains(c, F.lit("-")) & n.between(FIRST_YEAR, as_of_year + 1), n)


def year_of(c: Column, as_of_year: int) -> Column:
    """struct(year, reason): the year after the last hyphen; null with a reason where it can't be derived.

    Four digits are the year, two digits from 80 on are of 19xx, others of 20xx. The year has
    to lie between 1986 and the year after ``as_of_year``.
    """
    tail = _tail(c)
    reason = (
        F.when(c.isNull() | ~F.contains(c, F.lit("-")), "sin guion")
        .when((tail == "") | ~_digits(tail), "no numerico")
        .when(~F.length(tail).isin(2, 4), "longitud del anio")
        .when(~_written_year(tail).between(FIRST_YEAR, as_of_year + 1), "fuera del periodo")
    )
    return F.struct(year_number(c, as_of_year).alias("year"), reason.alias("reason"))


def filing_year(c: Column) -> Column:
    """Year at the very end, 2 to 4 digits; below 100 the pivot is 50."""
    n = F.nullif(F.regexp_extract(c, r"-(\d{2,4})\s*$", 1), F.lit("")).cast("int")
    return F.when(n < 100, n + F.when(n > FILING_PIVOT, 1900).otherwise(2000)).otherwise(n)


def variants(c: Column) -> Column:
    """The number with a four-digit and with a two-digit year; anything but digits, hyphen and such a year has no other form."""
    t = F.trim(c)
    number, year = F.substring_index(t, "-", 1), F.substring_index(t, "-", -1)
    century = F.when(year.try_cast("int") >= CENTURY_PIVOT, "19").otherwise("20")
    other = F.when(t.rlike(r"\A[0-9]+-(?:19|20)[0-9]{2}\z"), F.concat_ws("-", number, F.right(year, F.lit(2)))).when(t.rlike(r"\A[0-9]+-[0-9]{2}\z"), F.concat(number, F.lit("-"), century, year))
    return F.array_distinct(F.array_compact(F.array(t, other)))


def canonical(c: Column, as_of_year: int) -> Column:
    """One key for all variants: number and four-digit year where derivable, else the trimmed text."""
    t = F.trim(c)
    whole = F.concat_ws("-", F.substring_index(t, "-", 1), year_number(c, as_of_year).cast("string"))
    return F.when(year_number(c, as_of_year).isNull(), t).otherwise(whole)


def document_years(cases: Column, as_of_year: int, policy: str) -> Column:
    """Years of a document with several case numbers. policy: each (distinct, sorted), first, oldest, or first_case."""
    years = F.transform(cases, lambda c: year_number(c, as_of_year))
    known = F.array_compact(years)
    if policy == "each":
        return F.array_sort(F.array_distinct(known))
    if policy == "first":
        return F.try_element_at(known, F.lit(1))
    if policy == "oldest":
        return F.array_min(known)
    if policy == "first_case":
        return F.try_element_at(years, F.lit(1))
    raise ValueError(policy)
