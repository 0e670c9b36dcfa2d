"""Text normalisation as Column expressions.

``fold`` keeps lengths, so positions found in folded text are valid in the original.
All later patterns are plain ASCII on folded, lower-cased text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters that are folded one by one.
FOLD_FROM, FOLD_TO = "áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN"
PAGE_MARK = "===PAGINA n==="
#: White space as Python's ``str.split`` knows it.
BLANK = r"[\s\x1C-\x1F]"


def _bases() -> tuple[str, str]:
    """Every precomposed character of one letter and marks, and its letter: canonical decomposition without marks."""
    pairs = []
    for code in range(0xC0, 0x2000):
        c = chr(code)
        if unicodedata.decomposition(c)[:1] not in ("", "<"):
            base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if len(base) == 1 and base != c:
                pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_COMPOSED, _BASE = _bases()
#: The common part of that table, which nearly all text can do with.
_LATIN = sum(c < "\u0180" for c in _COMPOSED)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(c: Column) -> Column:
    return F.translate(c, FOLD_FROM, FOLD_TO)


def strip_accents(c: Column) -> Column:
    """Base letters: canonical decomposition without its marks, for all scripts below U+2000; syllables and ideographs beyond stay whole."""
    rare = F.translate(c, _COMPOSED, _BASE)
    latin = F.translate(c, _COMPOSED[:_LATIN], _BASE[:_LATIN])
    plain_text = F.when(c.rlike(r"[^\x00-\u017F]"), F.regexp_replace(rare, r"\p{Mn}", "")).otherwise(latin)
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain_text).otherwise(c)


def squash(c: Column) -> Column:
    """White space of any kind collapsed to single blanks, none at the ends."""
    # a single blank stays as it is, so that most texts have next to nothing to replace
    return F.trim(F.regexp_replace(c, rf"(?U) {BLANK}+|[\s\x1C-\x1F&&[^ ]]{BLANK}*", " "))


def trimmed(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def after(text: Column, flat: Column, pattern: str) -> Column:
    """What follows the first match of ``pattern`` in ``flat``, in the spelling of ``text`` (of equal length); null without a match."""
    # the first match is found as such, not by trying what may stand before it; only an empty rest leaves open whether there is one
    rest = F.regexp_extract(flat, rf"(?s)(?:{pattern})(.*)\z", 1)
    return let(rest, lambda r: F.when((r != "") | flat.rlike(pattern), F.right(text, F.length(r))))


def plain(c: Column) -> Column:
    return squash(F.lower(strip_accents(c)))


def quotable(c: Column) -> Column:
    """The form in which quotes and documents are compared: no page marks, accents, case or line ends; hyphens joined."""
    return F.regexp_replace(plain(F.regexp_replace(c, r"===PAGINA \d+===", " ")), r"\s*-\s*", "-")


def letters(c: Column) -> Column:
    return F.regexp_replace(F.upper(strip_accents(c)), "[^A-Z]", "")


def name_tokens(c: Column) -> Column:
    particles = ["DE", "LA", "LOS", "DEL", "Y"]
    parts = F.transform(F.split(squash(c), " "), letters)
    return F.filter(parts, lambda t: ~t.isin(*particles) & (t != ""))


def join_pages(pages: Column) -> Column:
    """Array of page texts to one text, each page opened by its mark."""
    return F.concat_ws("\n", F.transform(pages, lambda p, i: F.concat(F.lit("===PAGINA "), (i + 1).cast("string"), F.lit("===\n"), p)))


def split_pages(text: Column) -> Column:
    """Form-feed separated pages; a blank last page goes."""
    pages = F.split(text, "\f")
    return F.when(F.element_at(pages, -1).rlike(rf"(?U)\A{BLANK}*\z"), F.slice(pages, 1, F.greatest(F.size(pages) - 1, F.lit(0)))).otherwise(pages)


def page_of(text: Column, position: Column) -> Column:
    """Number of the last page mark before a 1-based position; null before the first."""
    marks = F.regexp_extract_all(F.substring(text, F.lit(1), position - 1), F.lit(r"===PAGINA (\d+)==="), 1)
    return F.try_element_at(marks, F.lit(-1)).cast("int")


def match_offsets(text: Column, pattern: str) -> Column:
    """Array of (start, end), 1-based and exclusive, of all matches: running lengths of what is between and of what matches."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["b"]) + F.length(x["m"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["b"])).alias("start"), (acc["at"] + F.length(x["b"]) + F.length(x["m"])).alias("end")))).alias("out"),
    )
    pairs = F.transform(found, lambda m, i: F.struct(F.get(between, i).alias("b"), m.alias("m")))
    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def tail(text: Column, size: int = 3000) -> Column:
    """The last ``size`` characters of the collapsed text."""
    return F.right(squash(text), F.lit(size))


def signature_block(text: Column, tail: int = 1500) -> Column:
    """What follows the last "Notifíquese", else the last ``tail`` characters."""
    parts = F.split(text, r"(?iu)notif[ií]quese", -1)
    return F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.right(text, F.lit(tail)))


def html_clean(c: Column) -> Column:
    """Tags out, the usual entities back, white space collapsed."""
    for entity, plain_text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain_text))
    return squash(c)


def first_present(m: Column, *labels: str) -> Column:
    """The first label of a map whose value isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(m[label]), F.lit("")) for label in labels])
