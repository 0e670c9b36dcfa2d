"""Values with provenance: layers, verification of quotes, long form, load model; matching of cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.casenum import canonical, variants
from foliant.functions.text import let, letters, quotable, signature_block
from foliant.operators.tables import keep

LAYERS = ("portal", "deterministic", "llm")


def extracted(value: Column, confidence: Column | float, provenance: str, quote: Column | None = None, page: Column | None = None, note: Column | None = None) -> Column:
    """A value with confidence, provenance, evidence (page and quote of at most 600 characters) and note; null if there is no value."""
    none = F.lit(None).cast("string")
    evidence = F.struct((page if page is not None else F.lit(None)).cast("int").alias("page"), F.substring(quote, 1, 600).alias("quote") if quote is not None else none.alias("quote"))
    confidence = confidence if isinstance(confidence, Column) else F.lit(confidence)
    return F.when(value.isNotNull(), F.struct(value.alias("value"), confidence.cast("double").alias("confidence"), F.lit(provenance).alias("provenance"), evidence.alias("evidence"), (note if note is not None else none).alias("note")))


def refused(note: Column, provenance: str = "llm") -> Column:
    """No value, and why there is none: struct like ``extracted``; null without a note."""
    none = F.lit(None).cast("string")
    evidence = F.lit(None).cast("struct<page:int,quote:string>")
    return F.when(note.isNotNull(), F.struct(none.alias("value"), F.lit(0.0).alias("confidence"), F.lit(provenance).alias("provenance"), evidence.alias("evidence"), note.alias("note")))


def layered(*layers: Column) -> Column:
    """The first layer that has a value: portal before deterministic before model; without any, the last that says why."""
    return F.coalesce(*[F.when(x["value"].isNotNull(), x) for x in layers], *reversed(layers))


def verify_quote(fact: Column, document: Column) -> Column:
    """verificada, no_encontrada, sin_evidencia or sin_valor; only what a model said is checked."""
    quote = fact["evidence"]["quote"]
    return (
        F.when(fact.isNull() | fact["value"].isNull(), "sin_valor").when(fact["provenance"] != "llm", "verificada").when(F.coalesce(F.trim(quote), F.lit("")) == "", "sin_evidencia")
        .when(F.contains(quotable(document), quotable(quote)), "verificada").otherwise("no_encontrada")
    )


#: Quotes of one or two words are tested against every document, so many at a time.
SHORT_BLOCK = 500


def quotes_in(documents: DataFrame, quotes: DataFrame, doc_id: str, quote_id: str, text: str = "text") -> DataFrame:
    """(doc_id, quote_id) of every quote that occurs in a document, both in the form of ``quotable``.

    All but the first and last word of a quote are whole words of a document that holds it, so the
    two meet by the one of these that the fewest documents have, and the candidates are tested on whole texts.
    Documents send ids and words that are some quote's only. Quotes of one or two words have no such
    word; they are dealt into blocks, and each document is tested against each block, in as many
    parts as the session shuffles into. Null and blank quotes occur nowhere.
    """
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    q = quotes.select(F.col(quote_id).alias("__q"), quotable(F.col(text)).alias("__quote")).where("__quote <> ''").withColumn("__w", words(F.col("__quote")))
    d = documents.select(F.col(doc_id).alias("__d"), quotable(F.col(text)).alias("__text"))
    inner = q.select("__q", F.explode(F.array_distinct(F.slice("__w", 2, F.greatest(F.size("__w") - 2, F.lit(0))))).alias("__word"))
    at = d.select("__d", F.explode(F.array_distinct(words(F.col("__text")))).alias("__word")).join(inner.select("__word").distinct(), "__word")
    common = at.groupBy("__word").agg(F.count("*").alias("__n"))
    # a quote with a word that no document has occurs nowhere
    keyed = inner.join(common, "__word", "left").groupBy("__q").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__word").alias("w"))).alias("k"))
    keyed = keyed.where("k.n > 0").select("__q", F.col("k.w").alias("__word"))
    found = at.join(keyed, "__word").select("__d", "__q").join(q.select("__q", "__quote"), "__q").join(d, "__d").where(F.contains("__text", "__quote")).select("__d", "__q")
    short = q.where(F.size("__w") <= 2).select("__q", "__quote")
    if n := short.count():
        blocks, parts = -(-n // SHORT_BLOCK), int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        upto = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
        dealt = short.groupBy(F.pmod(F.xxhash64("__q"), F.lit(blocks)).cast("int").alias("__block")).agg(F.collect_list(F.struct("__q", "__quote")).alias("__quotes")).withColumn("__part", upto(parts))
        tried = d.withColumn("__part", F.pmod(F.xxhash64("__d"), F.lit(parts)).cast("int")).withColumn("__block", upto(blocks)).join(dealt, ["__block", "__part"])
        hits = F.filter("__quotes", lambda x: F.contains(F.col("__text"), x["__quote"]))
        found = found.unionAll(tried.select("__d", F.explode(hits).alias("h")).select("__d", "h.__q"))
    return found.distinct().select(F.col("__d").alias(doc_id), F.col("__q").alias(quote_id))


def annotate(note: Column, status: Column, detail: Column | None = None) -> Column:
    """The note with a warning where a value isn't verified; the value stays."""
    why = F.coalesce(detail, F.lit("sin detalle")) if detail is not None else F.lit("sin detalle")
    return F.nullif(F.concat_ws("; ", note, F.when(status.isin("no_encontrada", "sin_evidencia"), F.concat(F.lit("EVIDENCIA "), status, F.lit(": "), why))), F.lit(""))


def facts_long(df: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """(key, field, value, confidence, provenance, page, quote, note) of every fact that has a value."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}.value").cast("string").alias("value"), F.col(f"{f}.confidence").alias("confidence"), F.col(f"{f}.provenance").alias("provenance"), F.col(f"{f}.evidence.page").alias("page"), F.col(f"{f}.evidence.quote").alias("quote"), F.col(f"{f}.note").alias("note")) for f in facts])
    return df.select(key, F.explode(each).alias("f")).select(key, "f.*").where("value is not null")


def attributes_long(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """(key, field, value) of a map column; present-but-empty values stay."""
    return df.select(key, F.explode(attributes).alias("field", "value"))


#: Card fields that describe the case, not who saw it.
TOPIC_FIELDS = ("Por tipo de antecedente", "Por tipo de acto reclamado", "Tema", "Materia", "Tema abordado", "Tema subyacente (texto libre", "Acto Reclamado", "Disposiciones impugnadas", "Norma Impugnada")


def topic_occurs(attributes: Column, term: str, fields: tuple[str, ...] = TOPIC_FIELDS) -> Column:
    """Whether a term occurs in the topic fields only, whatever its case."""
    return F.coalesce(F.exists(F.array(*[F.lit(f) for f in fields]), lambda f: F.contains(F.lower(F.coalesce(F.try_element_at(attributes, f), F.lit(""))), F.lit(term.lower()))), F.lit(False))


def same_case_join(a: DataFrame, b: DataFrame, case_a: str, case_b: str, as_of_year: int) -> DataFrame:
    """Equi-join on the canonical case number: 61-98 and 61-1998 are the same."""
    left = a.withColumn("__case", canonical(F.col(case_a), as_of_year))
    return left.join(b.withColumn("__case", canonical(F.col(case_b), as_of_year)), "__case").drop("__case")


def same_case(a: Column, b: Column) -> Column:
    return F.arrays_overlap(variants(a), variants(b))


def id_verdict(forward_case: Column, asked_case: Column, reverse_id: Column, asked_id: Column) -> Column:
    """Round trip id to case to id: consistente, otro_expediente, otro_id or no_comprobado (null is "not checked")."""
    return (
        F.when(forward_case.isNull() | reverse_id.isNull(), "no_comprobado").when(~same_case(forward_case, asked_case), "otro_expediente").when(reverse_id != asked_id, "otro_id").otherwise("consistente")
    )


def load_model(census: DataFrame, cards: DataFrame, decisions: DataFrame, documents: DataFrame, facts: DataFrame, links: DataFrame | None = None, cites: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables. ``links`` (of ``graph.procedural_groups``) and ``cites`` (of ``discovery.resolved``) fill two of them; officers stay empty, as nothing reliable names them."""
    spark = census.sparkSession
    empty = lambda s: spark.createDataFrame([], s)
    kinds = keep(census.select("id", "kind"), "id", "kind", "first")
    return {
        "census": census, "attributes": attributes_long(cards, "id", "attributes"), "decisions": decisions.where("effect is not null").join(kinds, "id", "left"),
        "documents": documents.withColumn("publication_status", F.lit("publicado")), "extractions": facts.where("value is not null"),
        "judicial_officers": empty("id string, name string"), "appeal_links": empty("id string, appealed_id string") if links is None else links, "citations": empty("id string, cited string") if cites is None else cites,
    }


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionAll(row)
    return out


def record_id(source: Column | str, ident: Column) -> Column:
    source = F.lit(source) if isinstance(source, str) else source
    return F.substring(F.sha2(F.concat_ws(":", source, ident.cast("string")), 256), 1, 16)


def raw_path(source: Column, year: Column, digest: Column, extension: Column) -> Column:
    return F.concat(F.concat_ws("/", source, F.coalesce(year.cast("string"), F.lit("unknown")), digest), F.lit("."), extension)
