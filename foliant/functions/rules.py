"""Ordered rule tables compiled to CASE: for Spark columns and for SQL oracles from the same data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import after, fold, let, squash


@dataclass(frozen=True)
class RuleSet:
    """(label, pattern) in order; the first pattern that matches folded, lower-cased text decides."""

    rules: tuple[tuple[str, str], ...]
    residual: str
    blank: str

    def classify(self, c: Column) -> Column:
        """struct(label, fragment): the label and the text that triggered it."""
        none = F.lit(None).cast("string")

        def read(t: Column) -> Column:
            out = F.when(F.trim(t) == "", F.struct(F.lit(self.blank).alias("label"), none.alias("fragment")))
            for name, pattern in self.rules:
                out = out.when(t.rlike(pattern), F.struct(F.lit(name).alias("label"), F.regexp_extract(t, pattern, 0).alias("fragment")))
            return out.otherwise(F.struct(F.lit(self.residual).alias("label"), none.alias("fragment")))

        return let(F.lower(fold(F.coalesce(c, F.lit("")))), read)

    def sql(self, expression: str) -> tuple[str, str]:
        """(label, fragment) as DuckDB expressions of an already folded, lower-cased SQL expression."""
        quote = lambda s: "'" + s.replace("'", "''") + "'"
        label = f"CASE WHEN trim({expression}) = '' THEN {quote(self.blank)}"
        fragment = f"CASE WHEN trim({expression}) = '' THEN NULL"
        for name, pattern in self.rules:
            label += f" WHEN regexp_matches({expression}, {quote(pattern)}) THEN {quote(name)}"
            fragment += f" WHEN regexp_matches({expression}, {quote(pattern)}) THEN regexp_extract({expression}, {quote(pattern)})"
        return label + f" ELSE {quote(self.residual)} END", fragment + " END"


def earliest(c: Column, needles: list[tuple[str, str]]) -> Column:
    """The label whose needle occurs first in the text (ties: the earlier in the list); null if none does."""
    places = lambda t: F.array(*[F.struct(F.instr(t, needle).alias("at"), F.lit(i).alias("i"), F.lit(label).alias("label")) for i, (needle, label) in enumerate(needles)])
    return F.array_min(F.filter(let(F.lower(fold(c)), places), lambda x: x["at"] > 0))["label"]


#: Petitioner categories, public bodies before private ones.
PETITIONERS = RuleSet(
    (
        ("Ministerio Público", r"ministerio publico|fiscal general"),
        ("PGN / Estado", r"procuraduria general|estado de guatemala"),
        ("PDH", r"procurador de los derechos humanos"),
        ("Municipalidad", r"municipalidad|alcald|concejo municipal"),
        ("Otra entidad pública", r"superintendencia|instituto guatemalteco|ministerio de|ministro|organismo|congreso|tribunal supremo|contralor|banco de guatemala|universidad de san carlos|consejo nacional|direccion general|funcionario o entidad del sector publico|registro|secretaria|credito hipotecario nacional|comision internacional contra la impunidad"),
        ("Gremial / cámara", r"camara de |cacif|comite coordinador|asociacion de (?:exportadores|azucareros|gerentes|industriales|bancos)|asociacion de la industria|gremial"),
        ("Empresa", r"sociedad anonima|\bs\.\s?a\.|limitada|\bltda\b|empresa|banco |compania|corporacion|cooperativa|\binc\.|distribuidora|\bs\.\s?a\b"),
        ("Sindicato", r"sindicato"),
        ("Org. social / ONG", r"asociacion|fundacion|comunidad|consejo de|colectivo|movimiento|frente|pueblo|indigena|organizacion|partido "),
    ),
    "Persona u otro (residual)",
    "Vacío",
)

# Outcome words of the portal's sense, in order, and of a clause, by position; what they do to a decision under review.
SENSE = [("con lugar", "con_lugar"), ("sin lugar", "sin_lugar"), ("otorga", "otorgado"), ("deniega", "denegado"), ("denegado", "denegado"), ("confirma", "confirmado"), ("revoca", "revocado"), ("modifica", "modificado"), ("anula", "anulado"), ("rechaza", "rechazado"), ("inadmi", "inadmitido"), ("suspend", "suspendido"), ("sobresee", "archivo_sobreseimiento"), ("archiva", "archivo_sobreseimiento")]
CLAUSE = [("sin lugar", "sin_lugar"), ("con lugar", "con_lugar"), ("deniega", "denegado"), ("otorga", "otorgado"), ("confirma", "confirmado"), ("revoca", "revocado"), ("modifica", "modificado"), ("anula", "anulado"), ("rechaza", "rechazado"), ("improcedente", "rechazado"), ("inadmi", "inadmitido"), ("suspend", "suspendido"), ("sobresee", "archivo_sobreseimiento"), ("archiva", "archivo_sobreseimiento")]
KEEPS, ALTERS, NOT_HEARD, ENDS, SUSPENDS = "mantiene_decision_inferior", "altera_decision_inferior", "no_entra_al_fondo", "termina_proceso", "suspende_actuacion"
REVIEW_EFFECT = {"confirmado": KEEPS, "sin_lugar": KEEPS, "denegado": KEEPS, "revocado": ALTERS, "modificado": ALTERS, "anulado": ALTERS, "con_lugar": ALTERS, "otorgado": ALTERS, "inadmitido": NOT_HEARD}
OUTCOMES = ("otorgado", "denegado", "confirmado", "revocado", "modificado", "anulado", "rechazado", "inadmitido", "suspendido", "con_lugar", "sin_lugar", "archivo_sobreseimiento", "otro")
REVIEW_KINDS = "apelacion|casacion|recurso"
# How a ruling names who brings the action (in order of trust), what ends the name, and what isn't one.
OPENINGS = (r"promovid[oa]s?\s*por\s*", r"que\s+promovi[oe]\s+", r"(?:planteado|interpuest[oa]|instad[oa])\s*por\s*")
BEFORE_VERB = r"(?U)\bque\s+([A-Z\u00C1-\u00DA].{2,300}?)\s*,?\s+promovi[oe]\s+contra\b"
NAME_END = r"\s*,?\s*(?:en\s+)?contra(?!\s+la\s+(?:impunidad|corrupcion))\b|\.\s+(?:El|La|Los|Las)\s+(?:entidad\s+)?(?:postulantes?|amparistas?|solicitantes?)\b|,?\s+quien(?:es)?\s+actu"
REPRESENTED = r"(?isU),?\s+por\s+medio\s+d.*\z"
GENERIC_NAME = r"(?iU)\A(?:el|la|los|las)\s+(?:postulantes?|amparistas?)\z"
NAME_WINDOW, LONGEST_NAME = 3000, 400


def outcome_of_sense(c: Column) -> Column:
    """Outcome by the portal's label: the first word that opens the text or stands before its first dash."""

    def read(t: Column) -> Column:
        head = F.substring_index(t, "-", 1)
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for needle, label in SENSE:
            out = out.when(F.startswith(t, F.lit(needle)) | F.contains(head, F.lit(needle)), label)
        return out

    return let(F.lower(fold(c)), read)


def outcome_of_clause(c: Column) -> Column:
    """The outcome whose word comes first in an operative clause."""
    return earliest(c, CLAUSE)


def procedural_effect(outcome: Column, kind: Column) -> Column:
    """Effect of an outcome; on what was appealed only in review types. What isn't unequivocal has none."""
    review = F.coalesce(F.lower(fold(kind)).rlike(REVIEW_KINDS), F.lit(False))
    table = F.create_map(*[F.lit(x) for kv in REVIEW_EFFECT.items() for x in kv])
    other = F.when(outcome.isin("inadmitido", "rechazado"), NOT_HEARD).when(outcome == "archivo_sobreseimiento", ENDS).when(outcome == "suspendido", SUSPENDS)
    return F.coalesce(F.when(review, F.try_element_at(table, outcome)), other)


def petitioner(c: Column, window: int = NAME_WINDOW, longest: int = LONGEST_NAME) -> Column:
    """Who brings the action, as the text spells it; null for generic names or if no form is found.

    The forms are tried in order; the first whose name has an end within ``longest`` characters decides.
    """

    def named(x: Column) -> Column:
        flat, text = x["flat"], x["text"]

        def form(opening: str) -> Column:
            def cut(rest: Column) -> Column:
                near = F.substring(fold(rest), 1, longest)
                return F.when(near.rlike(f"(?iU){NAME_END}"), F.substring(rest, F.lit(1), F.length(F.regexp_extract(near, rf"(?isU)\A(.*?)(?:{NAME_END})", 1))))

            return let(after(text, flat, f"(?iU){opening}"), cut)

        subject = F.nullif(F.regexp_extract(flat, BEFORE_VERB, 1), F.lit(""))
        return F.coalesce(*[form(o) for o in OPENINGS], F.substring(text, F.instr(flat, subject), F.length(subject)))

    def clean(name: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(name, REPRESENTED, ""), r"\A[ ,;]+|[ ,;]+\z", "")
        return let(bare, lambda b: F.when((b != "") & ~b.rlike(GENERIC_NAME), b))

    opening = F.substring(squash(F.substring(c, 1, 2 * window)), 1, window)
    return let(opening, lambda text: let(let(F.struct(text.alias("text"), fold(text).alias("flat")), named), clean))


def own_vote(c: Column) -> Column:
    """struct(own, foreign_only, mentions): separate opinions after the last operative marker are the court's own."""
    t = squash(F.coalesce(c, F.lit("")))
    # The words for a separate opinion and for the operative part.
    mention = r"(?i)voto\s+(razonado|disidente|concurrente)"
    parts = F.split(t, r"(?i)POR\s+TANTO|\bresuelve\s*:", -1)
    n = F.regexp_count(t, F.lit(mention))
    own = (F.size(parts) > 1) & F.element_at(parts, -1).rlike(mention)
    return F.struct(own.alias("own"), ((n > 0) & ~own).alias("foreign_only"), n.alias("mentions"))


def controlled_verdict(token: Column, prose: Column) -> Column:
    """A reviewer's verdict: the controlled token wins over prose; blank prose is null."""
    t = F.lower(F.trim(prose))
    # The words of a reviewer's prose, in their order.
    by_prose = F.when(t.rlike(r"(?U)\bno\s+altera"), "mantiene").when(t.contains("altera"), "altera").when(t.rlike("mantiene|confirma"), "mantiene").when(t.contains("otro"), "otro")
    chosen = F.nullif(F.lower(F.trim(token)), F.lit(""))
    return F.coalesce(F.when(chosen == "no_aplica", "otro").when(chosen.isin("altera", "mantiene"), chosen), by_prose)
