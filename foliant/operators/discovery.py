"""From what a source publishes to the tables: lenient conversion of its fields, and the joins along the chain of evidence."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.casenum import canonical, document_years
from foliant.functions.text import let, plain
from foliant.operators.tables import latest

#: The ISO forms of dates and times: with hyphens and colons or without, by day or by week, any one character between the two.
_DAY = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-[1-7])?|\d{4}W\d{2}[1-7]?"
_HOUR = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_ZONE = r"Z|[+-]\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?"
_ISO = rf"\A({_DAY})(?:.({_HOUR})({_ZONE})?)?\z"


def _day(text: Column) -> Column:
    """The date of one of ``_DAY``'s forms; null for a day that doesn't exist."""
    bare = F.regexp_replace(text, "-", "")
    year = F.substring(bare, 1, 4).try_cast("int")
    week, weekday = F.substring(bare, 6, 2).try_cast("int"), F.coalesce(F.nullif(F.substring(bare, 8, 1), F.lit("")).try_cast("int"), F.lit(1))
    fourth = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))  # always in the first week
    by_week = F.date_add(fourth, (week - 1) * 7 + weekday - 1 - F.weekday(fourth))
    exists = (week >= 1) & (F.date_part(F.lit("YEAROFWEEK"), by_week) == year)
    return F.when(F.contains(text, F.lit("W")), F.when(exists, by_week)).otherwise(F.try_to_date(bare, "yyyyMMdd"))


def _moment(c: Column) -> Column:
    """struct(day, time): null and null for what isn't ISO or doesn't exist; the time in UTC, an unnamed offset being UTC."""
    piece = lambda i: F.regexp_extract(c, _ISO, i)
    bare = F.regexp_replace(piece(2), ":", "")
    part = lambda at: F.coalesce(F.nullif(F.substring(bare, at, 2), F.lit("")), F.lit("00"))
    fraction = F.substring(F.regexp_extract(bare, r"[.,](\d+)", 1), 1, 6)
    offset = F.regexp_replace(piece(3), "[:Z]", "")
    zone = F.when(offset == "", "Z").otherwise(F.concat(F.substring(offset, 1, 3), F.lit(":"), F.rpad(F.substring(offset, 4, 2), 2, "0"), F.when(F.length(offset) > 5, F.concat(F.lit(":"), F.substring(offset, 6, 2))).otherwise("")))

    def told(day: Column) -> Column:
        written = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), part(1), F.lit(":"), part(3), F.lit(":"), part(5), F.lit("."), F.rpad(fraction, 6, "0"), zone)
        return F.struct(day.alias("day"), F.try_to_timestamp(written).alias("time"))

    return let(F.when(c.rlike(_ISO), _day(piece(1))), told)


def iso_date(c: Column, field: str) -> Column:
    """struct(value date, warning): the day an ISO date or time names, as written; null with a warning if it isn't one, without if it is blank."""
    return _told(c, let(_moment(c), lambda m: F.when(m["time"].isNotNull(), m["day"])), field)


def iso_time(c: Column, field: str) -> Column:
    """struct(value timestamp, warning): an ISO date or time; without an offset it is UTC."""
    return _told(c, _moment(c)["time"], field)


def _told(c: Column, value: Column, field: str) -> Column:
    warning = lambda v: F.when((F.coalesce(c, F.lit("")) != "") & v.isNull(), F.concat(F.lit(f"{field} no interpretable: '"), c, F.lit("'")))
    return let(F.struct(value.alias("v")), lambda s: F.struct(s["v"].alias("value"), warning(s["v"]).alias("warning")))


def as_list(json: Column, field: str) -> Column:
    """struct(value array<string>, warning) of a JSON value: a list as it is; a scalar becomes a list of one, with a warning; null stays null."""
    text = F.trim(json)
    many = F.from_json(text, "array<string>")
    scalar = F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v"), text)
    lone = ~F.startswith(text, F.lit("["))
    none = text.isNull() | (text == "null")
    return F.struct(F.when(none, F.lit(None).cast("array<string>")).when(lone, F.array(scalar)).otherwise(many).alias("value"), F.when(~none & lone, F.concat(F.lit(f"{field} llego como escalar y no como lista: "), text)).alias("warning"))


def warnings(*checked: Column) -> Column:
    """The warnings of several conversions, in order."""
    return F.array_compact(F.array(*[c["warning"] for c in checked]))


def ranked_pages(pages: DataFrame, documents: str = "documents") -> DataFrame:
    """One row per document of a page of results, with ``rank``, its place in the page from 0; the page's columns stay."""
    others = [c for c in pages.columns if c != documents]
    return pages.select(*others, F.posexplode(documents).alias("rank", "document"))


def first_seen(found: DataFrame, key: str, *order: str) -> DataFrame:
    """Of documents that several queries found, the first one by ``order`` (query, page, rank)."""
    place = F.struct(*order)
    return found.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*found.columns), place).alias("__r")).select("__r.*")


def main_case(cases: Column) -> Column:
    """The first case number, trimmed; null without any."""
    return F.try_element_at(F.transform(cases, lambda c: F.trim(c)), F.lit(1))


def day_prefix(c: Column) -> Column:
    """The date in the first ten characters; blank and unreadable ones are null."""
    return F.try_to_date(F.nullif(F.left(c, F.lit(10)), F.lit("")), "yyyy-MM-dd")


def census_table(census: DataFrame, as_of_year: int) -> DataFrame:
    """The census as the query layer has it: trimmed cases, the main one, its first derivable year, dates by their first ten characters."""
    cases = F.transform("cases", lambda c: F.trim(c))
    return census.select("id", cases.alias("cases"), main_case(F.col("cases")).alias("main_case"), document_years(cases, as_of_year, "first").alias("year"), "kind", day_prefix(F.col("decided")).alias("decided"), F.try_to_timestamp("published").alias("published"), F.col("pdf").alias("pdf_url"))


def documents_table(manifest: DataFrame) -> DataFrame:
    """Nested discovery records flattened: one row per document with source, canonical address, hash, type and place.

    ``manifest (source_document_id, source struct<source_id>, retrieved_at, document struct<...>)``; a
    record whose document wasn't fetched keeps its row with nulls.
    """
    d = lambda f: F.col(f"document.{f}")
    return manifest.select(F.col("source_document_id").alias("id"), F.col("source.source_id").alias("source_id"), d("canonical_url").alias("source_url"), "retrieved_at", d("sha256").alias("sha256"), d("mime_type").alias("mime_type"), d("local_path").alias("local_path"), F.lit("publicado").alias("publication_status"))


def with_text(discovered: DataFrame, parsed: DataFrame) -> DataFrame:
    """Discovered documents with their text's place, joined by the document's hash; ``readable`` says whether there is a text.

    Several parses of a hash count as their latest one (``parsed (sha256, text_path, parsed_at)``).
    Documents without a text stay, marked: they are unread, not empty.
    """
    paths = latest(parsed, "sha256", "text_path", "parsed_at")
    return discovered.join(paths, "sha256", "left").withColumn("readable", F.col("text_path").isNotNull())


def with_card(extracted: DataFrame, discovered: DataFrame) -> DataFrame:
    """Extractions with the attribute card of their discovery record: a left join on ``record_id``, nothing is lost."""
    cards = discovered.groupBy("record_id").agg(F.max_by("attributes", "retrieved_at").alias("attributes"))
    return extracted.join(cards, "record_id", "left")


def unread(sample: DataFrame, downloads: DataFrame, done: DataFrame) -> DataFrame:
    """What of a sample is downloaded and not read yet, with the file's path.

    ``downloads (id, outcome, path, at)`` is a log: an id counts if its latest line is ok, and
    a later failure takes it out again.
    """
    state = downloads.groupBy("id").agg(F.max_by(F.struct("outcome", "path"), F.struct("at", "outcome", "path")).alias("s"))
    paths = state.where("s.outcome = 'ok'").select("id", "s.path")
    return sample.join(paths, "id").join(done.select("id").distinct(), "id", "left_anti")


def citations(facts: DataFrame, id_col: str = "id", cites: str = "citations") -> DataFrame:
    """Edges (id, cited_case, text, place) of a citation graph from the facts' citations, one row per citation."""
    return facts.select(id_col, F.posexplode(f"{cites}.value").alias("place", "c")).select(id_col, F.col("c.case").alias("cited_case"), F.col("c.text").alias("text"), "place")


def resolved(edges: DataFrame, census: DataFrame, as_of_year: int, id_col: str = "id") -> DataFrame:
    """Citation edges with the cited document's id, by the canonical case number; a case that isn't in the census stays unresolved (null).

    A case with several documents gives the least id and ``documents``, their number, instead of
    one edge for each.
    """
    known = census.select(F.col("id").alias("cited_id"), F.explode("cases").alias("case")).select("cited_id", canonical(F.col("case"), as_of_year).alias("__case"))
    known = known.groupBy("__case").agg(F.min("cited_id").alias("cited_id"), F.countDistinct("cited_id").alias("documents"))
    return edges.withColumn("__case", canonical(F.col("cited_case"), as_of_year)).join(known, "__case", "left").drop("__case")


def cited_counts(edges: DataFrame, id_col: str = "id") -> DataFrame:
    """(cited_id, citing): how many documents cite each document."""
    return edges.where("cited_id is not null").groupBy("cited_id").agg(F.countDistinct(id_col).alias("citing"))


def search(documents: DataFrame, text: str, *words: str) -> DataFrame:
    """Documents that have all words, whole and whatever their case and accents, with ``hits``, the occurrences of all."""
    bare = ["".join(c for c in unicodedata.normalize("NFD", w.lower()) if unicodedata.category(c) != "Mn") for w in words]
    escaped = [r"(?U)\b" + "".join(c if c.isalnum() or c == "_" else rf"\{c}" for c in w) + r"\b" for w in bare]
    # one normal form per text: a filter on a plain column would repeat it, one on an exploded column can't
    n = let(plain(F.col(text)), lambda p: F.array(*[F.regexp_count(p, F.lit(e)) for e in escaped]))
    hits = documents.select("*", F.explode(F.array(n)).alias("__n")).where(F.forall("__n", lambda x: x > 0))
    return hits.withColumn("hits", F.aggregate("__n", F.lit(0), lambda a, x: a + x)).drop("__n")
