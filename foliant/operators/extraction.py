"""Facts of a document: what its card and its text say by rule, what a model adds, and how all of it is checked.

Each fact is a struct (value, confidence, provenance, evidence, note), see ``evidence.extracted``.
Layers only fill gaps: card before rules before model. Stored model answers are applied
again without a call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.dates import any_date, resolution_date
from foliant.functions.rules import OUTCOMES, outcome_of_clause, outcome_of_sense, procedural_effect
from foliant.functions.stats import clamp_confidence, confidence_note
from foliant.functions.text import fold, let, page_of, quotable, squash, trimmed
from foliant.operators.evidence import extracted, layered, refused, verify_quote

# Labels of a card by fact.
LABELS = {
    "petitioner": ("Postulante", "Solicitante"),
    "third_party": ("Tercero interesado",),
    "authority": ("Autoridad impugnada", "Autoridad denunciada"),
    "kind": ("Por tipo de expediente", "Materia"),
}
SENSE_LABELS = ("Sentido de la sentencia", "Sentido", "Fallo")
# Patterns on folded text, and their confidences.
CASE = r"(?i)EXPEDIENTES?\s+(?:ACUMULADOS\s+)?(?:No\.?\s*)?([0-9]{1,5}-[0-9]{2,4})"
COURT = r"(?i)dictada\s+por\s+(?:el|la|los|las)\s+([^,.]{8,160}?)(?=\s*,|\s+constituid|\s+en\s+el\s+amparo|\.)"
HEADING = r"(?im)^\s*(APELACION\s+DE\s+SENTENCIA\s+DE\s+AMPARO|AMPARO\s+EN\s+UNICA\s+INSTANCIA|INCONSTITUCIONALIDAD[^\n]{0,60}|OPINION\s+CONSULTIVA|APELACION\s+DE\s+AMPARO)\s*$"
SURE = {"card": 1.0, "sense": 0.97, "case": 0.95, "anchored": 0.97, "loose": 0.6, "heading": 0.8, "court": 0.85}

FACTS = ("case", "decided", "filed", "kind", "court", "appealed", "outcome", "effect", "petitioner", "third_party", "authority", "rapporteur")
ASKED = ("filed", "appealed", "court", "outcome", "rapporteur")
LONGEST_TEXT = 120_000


def located(text: Column, pattern: str) -> Column:
    """struct(value, quote, at) of the first match on folded text, in the spelling of the original; null without one."""

    def read(flat: Column) -> Column:
        whole, group = F.regexp_extract(flat, pattern, 0), F.regexp_extract(flat, pattern, 1)
        # where it begins: what the text has more than the match and all behind it
        at = F.length(flat) - F.length(F.regexp_extract(flat, rf"(?s)(?:{pattern}).*\z", 0)) + 1
        found = F.struct(whole.alias("whole"), group.alias("group"), at.alias("at"))
        return let(found, lambda f: F.struct(F.substring(text, f["at"] + F.instr(f["whole"], f["group"]) - 1, F.length(f["group"])).alias("value"), F.substring(text, f["at"], F.length(f["whole"])).alias("quote"), f["at"].alias("at")))

    return let(fold(text), lambda flat: F.when(flat.rlike(pattern), read(flat)))


def title(c: Column) -> Column:
    """Every run of letters with a capital first and small letters then."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), 0), F.initcap), "")


def of_card(card: Column, *labels: str) -> Column:
    """struct(label, value) of the first label whose value isn't blank."""
    each = [F.when(F.trim(F.coalesce(F.try_element_at(card, F.lit(x)), F.lit(""))) != "", F.struct(F.lit(x).alias("label"), F.trim(F.try_element_at(card, F.lit(x))).alias("value"))) for x in labels]
    return F.coalesce(*each)


def by_rule(df: DataFrame, text: str = "text", card: str = "card") -> DataFrame:
    """One more column per fact that needs no model; a null text or card gives nulls.

    An outcome that the card words otherwise than the taxonomy has no value, and a note that says so.
    """
    t = F.col(text)
    df = df.withColumns({"__kind": located(t, HEADING), "__case": located(t, CASE), "__court": located(t, COURT), "__date": resolution_date(t), "__sense": of_card(F.col(card), *SENSE_LABELS)})
    out: dict[str, Column] = {}
    for fact, labels in LABELS.items():
        c = of_card(F.col(card), *labels)
        out[fact] = extracted(c["value"], SURE["card"], "portal", F.concat_ws(": ", c["label"], c["value"]))
    sense, heading, case, date, court = (F.col(f"__{x}") for x in ("sense", "kind", "case", "date", "court"))
    outcome = outcome_of_sense(sense["value"])
    unknown = F.when(sense.isNotNull() & outcome.isNull(), F.concat(F.lit("el portal dice '"), sense["value"], F.lit("' y no encaja en la taxonomia literal")))
    out["outcome"] = layered(extracted(outcome, SURE["sense"], "portal", F.concat_ws(": ", sense["label"], sense["value"])), refused(unknown, "portal"))
    by_heading = extracted(title(squash(heading["value"])), SURE["heading"], "deterministic", F.trim(heading["value"]), page_of(t, heading["at"]))
    out["kind"] = layered(out["kind"], by_heading)
    out["case"] = extracted(case["value"], SURE["case"], "deterministic", case["quote"], page_of(t, case["at"]))
    loose = F.when(~date["anchored"], "sin encabezado del tribunal: puede ser la fecha de otra resolucion")
    out["decided"] = extracted(date["date"].cast("string"), F.when(date["anchored"], SURE["anchored"]).otherwise(SURE["loose"]), "deterministic", date["quote"], F.lit(1), loose)
    out["court"] = extracted(squash(court["value"]), SURE["court"], "deterministic", squash(court["quote"]), page_of(t, court["at"]))
    return df.withColumns(out).drop("__kind", "__case", "__court", "__date", "__sense")


def as_date(said: Column) -> Column:
    """A model's date as ISO text: as it is, or from words or digits; null if it is neither."""
    return F.coalesce(F.try_to_date(F.trim(said), "yyyy-MM-dd"), any_date(F.trim(said))["date"]).cast("string")


def as_outcome(said: Column) -> Column:
    """A word of the taxonomy as it is, else the outcome of the clause."""
    token = F.lower(F.trim(said))
    return F.when(token.isin(*OUTCOMES), token).otherwise(outcome_of_clause(said))


def said(answer: Column, convert=None, least: float = 0.0) -> Column:
    """A fact of a model's answer struct(value, quote, page, confidence).

    What isn't taken has no value, but a note that says why (see ``refusal``); null if nothing was said.
    """

    def read(value: Column) -> Column:
        taken = extracted(value, clamp_confidence(answer["confidence"]), "llm", F.trim(answer["quote"]), answer["page"], confidence_note(answer["confidence"]))
        why = refusal(answer, value, least)
        return F.when(why.isNotNull(), refused(F.concat(why, F.lit(": '"), answer["value"], F.lit("'")))).otherwise(taken)

    return let(convert(answer["value"]) if convert else F.nullif(answer["value"], F.lit("")), read)


def refusal(answer: Column, value: Column, least: float = 0.0) -> Column:
    """Why a model's value isn't taken: no quote, low confidence, not convertible; null if it is, or if it says nothing."""
    blank = lambda c: F.coalesce(trimmed(c), F.lit("")) == ""
    return F.when(~blank(answer["value"]), F.when(blank(answer["quote"]), "descartado sin cita").when(F.coalesce(clamp_confidence(answer["confidence"]), F.lit(0.0)) < least, "descartado por baja confianza").when(value.isNull(), "valor no convertible"))


def with_model(df: DataFrame, answers: str) -> DataFrame:
    """Fill the gaps of ``by_rule`` from a stored answer (struct of answers by fact); the effect is derived, never asked.

    Pure: the same for a fresh answer and a stored one, so a corrected conversion needs no new
    call. Facts that the answer struct doesn't have are left as they are. ``officers`` (struct of
    value array<struct<name,role>>, quote, page, confidence) and ``citations`` (value
    array<struct<case,text>>, confidence) always come from the model; officers without a quote
    are discarded, with a line in ``warnings``.
    """
    a, given = F.col(answers), {f.name for f in df.schema[answers].dataType.fields}
    convert = {"filed": as_date, "appealed": as_date, "outcome": as_outcome}
    none = F.lit(None).cast("struct<value:string,confidence:double,provenance:string,evidence:struct<page:int,quote:string>,note:string>")
    filled = df.withColumns({f: layered(F.col(f), said(a[f], convert.get(f))) if f in df.columns else said(a[f], convert.get(f)) for f in ASKED if f in given})
    filled = filled.withColumns({f: none for f in ASKED if f not in filled.columns})
    effect = procedural_effect(F.col("outcome.value"), F.coalesce(F.col("kind.value"), F.lit("")))
    note = F.concat(F.lit("derivado de outcome="), F.col("outcome.value"))
    out = {"effect": extracted(effect, F.col("outcome.confidence"), "deterministic", F.col("outcome.evidence.quote"), F.col("outcome.evidence.page"), note)}
    warnings = F.array().cast("array<string>")
    if "officers" in given:
        quoted = F.coalesce(trimmed(a["officers"]["quote"]), F.lit("")) != ""
        some = F.size(F.coalesce(a["officers"]["value"], F.array())) > 0
        out["officers"] = F.when(some & quoted, extracted(a["officers"]["value"], clamp_confidence(a["officers"]["confidence"]), "llm", a["officers"]["quote"], a["officers"]["page"]))
        warnings = F.when(some & ~quoted, F.array(F.lit("magistrados propuestos sin cita: descartados"))).otherwise(warnings)
    if "citations" in given:
        out["citations"] = F.when(F.size(F.coalesce(a["citations"]["value"], F.array())) > 0, extracted(a["citations"]["value"], clamp_confidence(a["citations"]["confidence"]), "llm"))
    return filled.withColumns({**out, "warnings": warnings})


def sendable(text: Column) -> Column:
    """Whether a text may be sent to a model: longer ones aren't cut, they stay unread."""
    return F.coalesce(F.length(text) <= LONGEST_TEXT, F.lit(False))


def known_summary(*facts: str) -> Column:
    """What is known already, a line per fact, for a prompt."""
    return F.concat_ws("\n", *[F.when(F.col(f"{x}.value").isNotNull(), F.concat(F.lit(f"- {x}: "), F.col(f"{x}.value"), F.lit(" (fuente: "), F.col(f"{x}.provenance"), F.lit(")"))) for x in facts])


def verify_each(values: Column, document: Column) -> Column:
    """struct(status, missing): names or citations are looked for one by one."""
    doc = quotable(document)
    missing = F.filter(values, lambda v: ~F.coalesce(F.contains(doc, quotable(v)), F.lit(False)) | (quotable(v) == ""))
    status = F.when(values.isNull() | (F.size(values) == 0), "sin_valor").when(F.size(missing) == 0, "verificada").otherwise("no_encontrada")
    return F.struct(status.alias("status"), missing.alias("missing"))


def prompt_stamp(version: str, text: str) -> dict[str, Column]:
    """Columns that name the prompt behind an answer."""
    return {"prompt_version": F.lit(version), "prompt_sha256": F.sha2(F.lit(text), 256)}


def coverage_report(df: DataFrame, facts: list[str], text: str, tokens: tuple[str, ...] = ("input_tokens", "output_tokens")) -> DataFrame:
    """(what, name, n) over all documents: facts that have a value, by field and by provenance, how a model's quotes were verified, tokens used, and the documents themselves.

    A count never goes without its denominator; what doesn't occur has no row. One scan.
    """
    entry = lambda what, name, n: F.struct(F.lit(what).alias("what"), (name if isinstance(name, Column) else F.lit(name)).alias("name"), n.cast("long").alias("n"))
    one = F.lit(1)
    each = [entry("documents", "all", one)]
    each += [entry("tokens", t.removesuffix("_tokens"), F.coalesce(F.col(t), F.lit(0))) for t in tokens if t in df.columns]
    for f in facts:
        there = F.col(f"{f}.value").isNotNull()
        each += [F.when(there, entry("coverage", f, one)), F.when(there, entry("provenance", F.col(f"{f}.provenance"), one))]
        each.append(F.when(there & (F.col(f"{f}.provenance") == "llm"), entry("verification", verify_quote(F.col(f), F.col(text)), one)))
    return df.select(F.explode(F.array_compact(F.array(*each))).alias("e")).groupBy("e.what", "e.name").agg(F.sum("e.n").alias("n")).where("n > 0")
