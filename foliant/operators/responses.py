"""What a response is worth, how a document's text is to be had, and addresses.

An empty response isn't a negative result: no outcome means "does not exist".
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import BLANK, let

# Outcomes of a fetch, and the marks of a challenge (which is noted, never evaded).
OK, NOT_CHECKED, HTTP_ERROR, EMPTY, SHORT, WRONG_TYPE, ROBOTS, CHALLENGE = "ok", "not_checked", "http_error", "empty_body", "suspiciously_short", "wrong_content_type", "blocked_by_robots", "blocked_by_challenge"
CHALLENGES = ("Just a moment...", "cf-browser-verification", "challenge-platform", "Checking your browser")
HEAD_BYTES = 4096


class NotSubstantive(RuntimeError):
    """A response came, but it can't be taken for content."""


@dataclass(frozen=True)
class Expectation:
    """What a response has to be: its kind (json, pdf, html or text), content type, size, marks, keys and words."""

    kind: str
    min_bytes: int
    content_type: str | None = None
    markers: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    min_words: int = 0
    challenges: tuple[str, ...] = CHALLENGES


# What the kinds of responses have to be. Of JSON the structure decides, not the size.
API = Expectation("json", 0, "application/json", keys=("documentos", "recordsTotal"))
CARD = Expectation("html", 1500, "text/html", markers=("Atributos del Expediente", "No. Expediente"), min_words=40)
PDF = Expectation("pdf", 2048, "application/pdf", markers=("%PDF-",))
DOC = replace(PDF, content_type="application/msword", markers=())
DOCX = replace(PDF, content_type="application/vnd.openxmlformats-officedocument.wordprocessingml", markers=("PK",))
ROBOTS_FILE = Expectation("text", 1, "text/plain")
FORMATS = {"pdf": PDF, "doc": DOC, "docx": DOCX}


def format_of(url: Column) -> Column:
    """The expected format by the extension: pdf, doc or docx; pdf where it is none of these."""
    extension = F.lower(F.substring_index(url, ".", -1))
    return F.when(extension.isin(*FORMATS), extension).otherwise("pdf")


def fetch_outcome(status: Column, body: Column, content_type: Column, expect: Expectation) -> Column:
    """struct(outcome, note) of one response (body as text or binary), by ordered rules; without a status nothing was checked."""

    def read(x: Column) -> Column:
        raw, code = x["raw"], x["status"]
        head, text, n = F.substring(raw, 1, HEAD_BYTES).cast("string"), raw.cast("string"), F.octet_length(raw)
        result = lambda outcome, *note: F.struct(F.lit(outcome).alias("outcome"), F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in note]).alias("note"))
        challenge = F.try_element_at(F.filter(F.array(*[F.lit(m) for m in expect.challenges]).cast("array<string>"), lambda m: F.contains(head, m)), F.lit(1))
        out = F.when(code.isNull(), result(NOT_CHECKED, "sin respuesta"))
        out = out.when(code.isin(401, 403) & challenge.isNotNull(), result(CHALLENGE, "desafio anti-bot en HTTP ", code)).when(code >= 400, result(HTTP_ERROR, "HTTP ", code))
        out = out.when(n == 0, result(EMPTY, "HTTP ", code, " con cuerpo vacio")).when(challenge.isNotNull(), result(CHALLENGE, "desafio anti-bot: '", challenge, "'"))
        if expect.content_type:
            out = out.when(~F.startswith(F.lower(x["type"]), F.lit(expect.content_type)), result(WRONG_TYPE, "content-type '", x["type"], f"', se esperaba '{expect.content_type}'"))
        if expect.kind == "json":
            keys = F.json_object_keys(text)
            missing = F.array_except(F.array(*[F.lit(k) for k in expect.keys]).cast("array<string>"), keys)
            value = F.try_parse_json(text)
            out = out.when(value.isNull(), result(SHORT, "JSON invalido")).when(~F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), result(WRONG_TYPE, "el JSON raiz no es un objeto"))
            out = out.when(F.size(missing) > 0, result(WRONG_TYPE, "faltan claves ['", F.concat_ws("', '", missing), "']"))
        else:
            out = out.when(n < expect.min_bytes, result(SHORT, n, f" bytes, minimo esperado {expect.min_bytes}"))
        if expect.kind in ("html", "text") and expect.min_words:
            words = F.size(F.filter(F.split(head, f"(?U){BLANK}+"), lambda w: w != ""))
            out = out.when(words < expect.min_words, result(SHORT, words, f" palabras, minimo esperado {expect.min_words}"))
        for mark in expect.markers:
            out = out.when(~F.contains(text, F.lit(mark)), result(SHORT, f"falta el marcador '{mark}'"))
        return out.otherwise(F.struct(F.lit(OK).alias("outcome"), F.lit(None).cast("string").alias("note")))

    binary = F.coalesce(body.cast("binary"), F.lit("").cast("binary"))
    return let(F.struct(status.cast("int").alias("status"), binary.alias("raw"), F.coalesce(content_type, F.lit("")).alias("type")), read)


def evaluate(status: int | None, body: bytes, content_type: str, expect: Expectation) -> tuple[str, str | None]:
    """``fetch_outcome`` of one response where it arrives, for the readers of a source."""
    head, text = body[:HEAD_BYTES].decode("utf-8", "replace"), body.decode("utf-8", "replace")
    challenge = next((m for m in expect.challenges if m in head), None)
    if status is None:
        return NOT_CHECKED, "sin respuesta"
    if status >= 400:
        return (CHALLENGE, f"desafio anti-bot en HTTP {status}") if challenge and status in (401, 403) else (HTTP_ERROR, f"HTTP {status}")
    faults: list[tuple[bool, str, str]] = [
        (not body, EMPTY, f"HTTP {status} con cuerpo vacio"),
        (challenge is not None, CHALLENGE, f"desafio anti-bot: {challenge!r}"),
        (bool(expect.content_type) and not content_type.lower().startswith(expect.content_type or ""), WRONG_TYPE, f"content-type {content_type!r}, se esperaba {expect.content_type!r}"),
        (expect.kind != "json" and len(body) < expect.min_bytes, SHORT, f"{len(body)} bytes, minimo esperado {expect.min_bytes}"),
    ]
    if expect.kind == "json" and not any(f[0] for f in faults):
        try:
            keys = json.loads(text)
        except json.JSONDecodeError:
            return SHORT, "JSON invalido"
        missing = [k for k in expect.keys if not isinstance(keys, dict) or k not in keys]
        faults += [(not isinstance(keys, dict), WRONG_TYPE, "el JSON raiz no es un objeto"), (bool(missing), WRONG_TYPE, f"faltan claves {missing}")]
    if expect.kind in ("html", "text"):
        faults.append((len(head.split()) < expect.min_words, SHORT, f"{len(head.split())} palabras, minimo esperado {expect.min_words}"))
    faults += [(m not in text, SHORT, f"falta el marcador {m!r}") for m in expect.markers]
    return next(((outcome, note) for bad, outcome, note in faults if bad), (OK, None))


# Producers of text layers that are scanners or others' OCR (whole words), and the routes to a text.
SCANNERS = ("leanscan", "scanner", "scansnap", "xerox", "kyocera", "ricoh", "canon", "epson", "hp digital sending", "toshiba", "sharp", "abbyy", "finereader", "tesseract", "ocrmypdf")
NATIVE, OCR_QUALITY, OCR_ABSENT, OCR_PRODUCER, HUMAN, UNCHECKED = "capa_nativa", "ocr_por_calidad", "ocr_por_ausencia", "ocr_por_productor", "revision_humana", "no_comprobado"


def by_scanner(producer: Column, creator: Column | None = None) -> Column:
    """Whether a scanner or another OCR made the text layer; without a producer nobody is accused."""
    return F.lower(F.concat_ws(" ", producer, *([] if creator is None else [creator]))).rlike(r"(?U)\b(?:" + "|".join(SCANNERS) + r")\b")


def parse_route(readable: Column, scanner: Column, verdict: Column, ocr: str = "off", ocr_done: Column | None = None, ocr_verdict: Column | None = None) -> Column:
    """struct(route, note): how a document's text was had, or that people have to look.

    A scanner's layer is thrown away unseen; other layers stay if they read as prose. ``ocr`` is
    "off" (such documents wait for people), else ``ocr_done`` says whether the tool worked and
    ``ocr_verdict`` what its text is worth. A null ``readable`` or ``ocr_done`` counts as failed.
    """
    route = lambda r, note=None: F.struct(F.lit(r).alias("route") if isinstance(r, str) else r.alias("route"), F.lit(note).cast("string").alias("note"))
    why = F.when(scanner, OCR_PRODUCER).when(verdict == "sin_capa_de_texto", OCR_ABSENT).otherwise(OCR_QUALITY)
    out = F.when(~F.coalesce(readable, F.lit(False)), route(UNCHECKED, "no se pudo leer")).when(~scanner & (verdict == "usable"), route(NATIVE))
    if ocr == "off":
        return out.otherwise(route(HUMAN, "OCR desactivado"))
    out = out.when(~F.coalesce(ocr_done, F.lit(False)), route(UNCHECKED, "OCR fallo"))
    return out.when(ocr_verdict == "usable", route(why)).otherwise(route(HUMAN, "ni la capa original ni el OCR dieron texto usable"))


def usable_route(route: Column) -> Column:
    """Whether a route gave a text; not the same as an empty document."""
    return route.isNotNull() & ~route.isin(HUMAN, UNCHECKED)


_URL = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
# Characters of a path that aren't escaped, besides letters and digits.
SAFE_IN_PATH = "/%:@!$&'()*+,;=~_.-"
_PLAIN_BYTES = {c: f"{ord(c):02X}" for c in map(chr, range(128)) if c.isalnum() or c in SAFE_IN_PATH}


def quote_path(path: Column) -> Column:
    """Percent-encoded UTF-8, but for safe characters; what is encoded already stays."""
    plain = F.create_map(*[F.lit(x) for c, code in _PLAIN_BYTES.items() for x in (code, c)])
    bytes_of = F.regexp_extract_all(F.hex(F.encode(path, "UTF-8")), F.lit("(..)"), 1)
    quoted = F.array_join(F.transform(bytes_of, lambda b: F.coalesce(F.try_element_at(plain, b), F.concat(F.lit("%"), b))), "")
    return F.when(path.rlike(r"[^A-Za-z0-9/%:@!$&'()*+,;=~_.\-]"), quoted).otherwise(path)


def canonical_url(c: Column, hosts: list[str], host: str) -> Column:
    """struct(url, rewritten): known address hosts become the canonical one, which is asked by https; the path is percent-encoded. Idempotent.

    Query and fragment stay as they are, and so do other hosts.
    """

    def read(x: Column) -> Column:
        scheme, netloc, path = F.lower(x["scheme"]), x["netloc"], x["path"]
        name = F.lower(F.regexp_extract(netloc, r"\A(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))
        moved = name.isin(*hosts)
        place = F.when(moved, F.lit(host)).otherwise(netloc)
        safer = (place == host) & (scheme == "http")
        new_scheme, new_path = F.when(safer, "https").otherwise(scheme), quote_path(path)
        optional = lambda mark, part: F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")
        url = F.concat(F.when(new_scheme != "", F.concat(new_scheme, F.lit(":"))).otherwise(""), F.when(place != "", F.concat(F.lit("//"), place)).otherwise(""), new_path, optional("?", x["query"]), optional("#", x["fragment"]))
        return F.struct(url.alias("url"), (moved | safer | (new_path != path)).alias("rewritten"))

    part = lambda i, name: F.regexp_extract(c, _URL, i).alias(name)
    return F.when(c.isNotNull(), let(F.struct(part(1, "scheme"), part(2, "netloc"), part(3, "path"), part(4, "query"), part(5, "fragment")), read))
