"""Queries along the chain of evidence: census, cards, samples, downloads, texts, citations, search, answers of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import stats
from foliant.functions.text import page_of
from foliant.operators import discovery, evidence, extraction, indicators, model, study, tables
from foliant.plans.base import AS_OF, query, t
from foliant.plans.parsers import HOST, HOSTS
from foliant.sources import readers

PERIODS = [("1992-1993", 1992, 1993), ("1994-1995", 1994, 1995), ("1996-1997", 1996, 1997)]
_PERIOD = "CASE " + " ".join(f"WHEN year BETWEEN {a} AND {b} THEN '{p}'" for p, a, b in PERIODS) + " END"


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), F.year("o_orderdate").alias("year"))


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of an order's document: none for open orders."""
    pdf = F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("http://192.0.2.10/s/"), F.col("o_orderkey"), F.lit(" AC.pdf"))).otherwise("")
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pdf.alias("pdf"))


_ELIGIBLE = f"e AS (SELECT id, kind, year, {_PERIOD} AS period, 'http://192.0.2.10/s/' || id || ' AC.pdf' AS pdf FROM (SELECT o_orderkey AS id, o_orderpriority AS kind, year(o_orderdate) AS year, o_orderstatus AS s FROM orders) WHERE s <> 'O' AND kind = '1-URGENT' AND {_PERIOD} IS NOT NULL)"


@query(f"WITH {_ELIGIBLE} SELECT id, kind, year, period, pdf FROM e")
def q60_eligible_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.eligible(_cards(spark, sf_dir), _addresses(spark, sf_dir), "1-URGENT", PERIODS)


@query(f"WITH {_ELIGIBLE} SELECT id, period FROM e QUALIFY row_number() OVER (PARTITION BY period ORDER BY md5('{tables.SEED_STUDY}:' || period || ':' || id), id::VARCHAR) <= 200")
def q61_study_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.study_sample(_cards(spark, sf_dir), _addresses(spark, sf_dir), 200, kind="1-URGENT", periods=PERIODS).select("id", "period")


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = F.col("o_orderpriority"), F.col("o_orderkey")
    effect = F.when(p.isin("1-URGENT", "2-HIGH"), "altera").when(p == "5-LOW", "ambiguo").otherwise("mantiene")
    rule = F.when(effect == "altera", F.when(F.col("o_totalprice") > 150000, "confirma con modificacion").when(F.col("o_totalprice") > 50000, "revoca")).when(effect == "mantiene", "confirma")
    return t(spark, sf_dir, "orders").select(k.alias("id"), F.array(F.concat(k, F.lit("-98"))).alias("cases"), F.year("o_orderdate").alias("year"), effect.alias("effect"), rule.alias("rule"), F.repeat(F.concat(F.lit("p"), k, F.lit(" ")), F.lit(80)).alias("point"))


@query(f"""WITH b AS (SELECT o_orderkey AS id, year(o_orderdate) AS year, o_orderstatus AS s, o_totalprice AS price, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'altera' WHEN o_orderpriority='5-LOW' THEN 'ambiguo' ELSE 'mantiene' END AS effect FROM orders),
d AS (SELECT *, CASE effect WHEN 'altera' THEN CASE WHEN price>150000 THEN 'confirma con modificacion' WHEN price>50000 THEN 'revoca' END WHEN 'mantiene' THEN 'confirma' END AS rule FROM b),
x AS (SELECT *, CASE WHEN effect='mantiene' THEN 'mantiene' WHEN effect='altera' AND rule='confirma con modificacion' THEN 'altera_regla_discutida' WHEN effect='altera' THEN 'altera_otras_reglas' END AS estrato FROM d),
y AS (SELECT * FROM x WHERE estrato IS NOT NULL QUALIFY row_number() OVER (PARTITION BY estrato ORDER BY md5('{tables.SEED_STUDY}:' || estrato || ':' || id), id::VARCHAR) <= CASE estrato WHEN 'mantiene' THEN 40 ELSE 30 END)
SELECT row_number() OVER (ORDER BY md5('{tables.SEED_STUDY}:orden:' || id), id::VARCHAR)::INT AS n, id || '-98' AS expediente, year::VARCHAR AS anio, CASE WHEN s<>'O' THEN 'https://{HOST}/s/' || id || '%20AC.pdf' ELSE '' END AS url_del_documento,
'' AS VEREDICTO_HUMANO_altera_mantiene_otro, '' AS VEREDICTO_CONTROLADO_altera_mantiene_no_aplica, '' AS NOTA, substr(repeat('p' || id || ' ', 80),1,300) AS lo_que_leyo_la_maquina, coalesce(rule,'') AS regla_que_disparo, effect AS veredicto_maquina, '' AS "veredicto_maquina_previo_2026-08-30", estrato, id FROM y""")
def q62_review_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.review_rows(_decided(spark, sf_dir), _addresses(spark, sf_dir), HOSTS, HOST)


@query("""WITH s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_max(event_id, (ts, event_id)) AS last_id FROM events GROUP BY user_id)
SELECT c_custkey AS id, c_name, 'f/' || last_id AS path FROM customer JOIN s ON user_id=c_custkey WHERE last_type='purchase' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice>499000)""")
def q63_unread_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = t(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.when(F.col("event_type") == "purchase", "ok").otherwise("http_error").alias("outcome"), F.concat(F.lit("f/"), F.col("event_id")).alias("path"), F.struct("ts", "event_id").alias("at"))
    done = t(spark, sf_dir, "orders").where("o_totalprice > 499000").select(F.col("o_custkey").alias("id"))
    return discovery.unread(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name"), log, done)


@query("""WITH p AS (SELECT sha256(coalesce(text,'')) AS h, arg_max(source || '/' || doc_id, doc_id) AS text_path FROM documents WHERE lang IN ('en','de') GROUP BY 1)
SELECT doc_id, text_path, text_path IS NOT NULL AS readable FROM documents LEFT JOIN p ON sha256(coalesce(text,''))=h""")
def q64_texts_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    parsed = d.where(F.col("lang").isin("en", "de")).select("sha256", F.concat_ws("/", "source", "doc_id").alias("text_path"), F.col("doc_id").alias("parsed_at"))
    return discovery.with_text(d.select("doc_id", "sha256"), parsed).select("doc_id", "text_path", "readable")


@query("""WITH c AS (SELECT o_custkey AS r, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY 1) SELECT c_custkey AS record_id, c_mktsegment AS value, priority FROM customer LEFT JOIN c ON r=c_custkey""")
def q65_cards_of_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record_id"), F.create_map(F.lit("Fallo"), F.col("o_orderpriority")).alias("attributes"), F.struct("o_orderdate", "o_orderkey").alias("retrieved_at"))
    facts = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record_id"), F.col("c_mktsegment").alias("value"))
    return discovery.with_card(facts, found).select("record_id", "value", F.col("attributes")["Fallo"].alias("priority"))


@query("""SELECT o_orderkey AS id, o_orderkey || '-2001' AS main_case, 2001 AS year, o_orderdate::DATE AS decided, CASE WHEN o_orderkey % 2 = 0 THEN 'x.pdf' END AS pdf_url FROM orders""")
def q66_census_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    census = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array(F.concat(F.lit(" "), k, F.lit("-2001 ")), F.concat(k, F.lit("-99"))).alias("cases"), F.col("o_orderpriority").alias("kind"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("decided"), F.lit("").alias("published"), F.when(F.col("o_orderkey") % 2 == 0, "x.pdf").alias("pdf"))
    return discovery.census_table(census, AS_OF).select("id", "main_case", "year", "decided", "pdf_url")


@query("SELECT doc_id AS id, source AS source_id, CASE WHEN lang='en' THEN 'https://h/' || doc_id END AS source_url, CASE WHEN lang='en' THEN sha256(coalesce(text,'')) END AS sha256, 'publicado' AS publication_status FROM documents")
def q67_documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.struct(F.concat(F.lit("https://h/"), F.col("doc_id")).alias("canonical_url"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), F.lit("text/plain").alias("mime_type"), F.lit(None).cast("string").alias("local_path"))
    manifest = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_document_id"), F.struct(F.col("source").alias("source_id")).alias("source"), F.lit("2020-01-01").alias("retrieved_at"), F.when(F.col("lang") == "en", ref).alias("document"))
    return discovery.documents_table(manifest).select("id", "source_id", "source_url", "sha256", "publication_status")


@query("""WITH r AS (SELECT l_partkey AS id, l_orderkey AS query, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS rank FROM lineitem), f AS (SELECT id, min({'query': query, 'rank': rank}) AS s FROM r GROUP BY id)
SELECT id, s.query AS query, s.rank AS rank FROM f""")
def q68_pages_of_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as result pages, their lines as the documents found: the rank in the page, and where each part was seen first."""
    pages = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("query")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("documents"))
    found = discovery.ranked_pages(pages).select(F.col("document.l_partkey").alias("id"), "query", F.col("rank").cast("long").alias("rank"))
    return discovery.first_seen(found, "id", "query", "rank")


@query("""WITH e AS (SELECT o_orderkey AS id, o_custkey || '-1998' AS cited FROM orders UNION ALL SELECT o_orderkey, (o_custkey + 1000000) || '-98' FROM orders), c AS (SELECT c_custkey AS cited_id, c_custkey || '-98' AS k FROM customer)
SELECT cited_id, count(DISTINCT id) AS citing FROM e JOIN c ON replace(cited,'-1998','-98')=k GROUP BY 1""")
def q69_citation_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    cite = lambda c: F.struct(F.concat(c.cast("string"), F.lit("-1998")).alias("case"), F.lit("véase").alias("text"))
    facts = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.struct(F.array(cite(F.col("o_custkey")), cite(F.col("o_custkey") + 1000000)).alias("value")).alias("citations"))
    census = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.array(F.concat(F.col("c_custkey").cast("string"), F.lit("-98"))).alias("cases"))
    return discovery.cited_counts(discovery.resolved(discovery.citations(facts), census, AS_OF))


@query("""WITH p AS (SELECT doc_id, lower(strip_accents(text)) AS x FROM documents), n AS (SELECT doc_id, len(list_filter(regexp_split_to_array(x, '[^\\p{L}\\p{N}_]+'), lambda w: w='license')) AS a, len(list_filter(regexp_split_to_array(x, '[^\\p{L}\\p{N}_]+'), lambda w: w='under')) AS b FROM p)
SELECT doc_id, (a+b)::INT AS hits FROM n WHERE a>0 AND b>0""")
def q70_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.search(t(spark, sf_dir, "documents").select("doc_id", "text"), "text", "LICENSE", "ünder").select("doc_id", "hits")


@query("SELECT o_custkey AS id, max(o_orderkey) AS last_order, arg_max(o_orderpriority, o_orderkey) AS last_value, min(o_orderkey) AS first_order, arg_min(o_orderpriority, o_orderkey) AS first_value FROM orders GROUP BY 1")
def q71_keep_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards are maps; the last and the first card of each id stay."""
    cards = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("at"), F.create_map(F.lit("Fallo"), F.col("o_orderpriority")).alias("card"))
    one = lambda which: tables.keep(cards, "id", "at", which).select("id", F.col("at").alias(f"{which}_order"), F.col("card")["Fallo"].alias(f"{which}_value"))
    return one("last").join(one("first"), "id")


@query("SELECT field, state, n FROM (SELECT 'state' AS field, o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'alerts', 'with', count(*) FILTER (o_totalprice>200000) FROM orders UNION ALL SELECT 'zero', z.s, count(o_orderkey) FROM (VALUES ('F'),('O'),('P'),('X')) z(s) LEFT JOIN orders ON o_orderstatus=z.s GROUP BY 2 UNION ALL SELECT 'progress', 'processed', count(*) FROM orders UNION ALL SELECT 'progress', 'failed', count(*) FILTER (o_orderstatus='P') FROM orders)")
def q72_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("state"), F.when(F.col("o_totalprice") > 200000, F.array(F.lit("caro"))).otherwise(F.array().cast("array<string>")).alias("alerts"))
    states = tables.state_counts(o, "state", "alerts")
    zero = tables.zero_filled_counts(o, "state", ["F", "O", "P", "X"]).select(F.lit("zero").alias("field"), "state", "n")
    p = tables.progress(o, failed=F.col("state") == "P")
    progress = p.select(F.lit("progress").alias("field"), F.explode(F.create_map(F.lit("processed"), F.col("processed"), F.lit("failed"), F.col("failed"))).alias("state", "n"))
    return states.unionAll(zero).unionAll(progress)


@query(f"""WITH d AS (SELECT doc_id, coalesce(text,'') AS text, length(coalesce(text,'')) > {extraction.LONGEST_TEXT} AS long FROM documents)
SELECT doc_id, CASE WHEN NOT long THEN sha256(text) END AS rapporteur, CASE WHEN NOT long THEN length(text)::BIGINT END AS input_tokens, long AS warned, substr(sha256('s' || chr(10) || '{{known}} {{text}}'),1,8) AS prompt FROM d""")
def q73_model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for a model says the digest of each whole document that it is shown."""
    d = t(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("").alias("known"))
    asked = model.answers(model.ask(d, "text", "known", model.Digest, model.Prompt("1", "s", "{known} {text}"), "doc_id"))
    said = extraction.said(F.col("answer.rapporteur"))
    return asked.select("doc_id", said["value"].alias("rapporteur"), "input_tokens", F.col("warning").isNotNull().alias("warned"), F.left("prompt_sha256", F.lit(8)).alias("prompt"))


_MIDDLE_SQL = "substr(text,length(text)//2+1,80)"


@query(rf"""WITH f AS (SELECT doc_id, lang, quality, CASE WHEN doc_id % 3 = 0 THEN 'zz' || doc_id || 'zz' ELSE coalesce({_MIDDLE_SQL}, '') END AS q, doc_id % 3 = 0 AS made_up FROM documents LEFT JOIN labels USING (doc_id)), n AS (SELECT count(*) AS documents FROM documents),
v AS (SELECT CASE WHEN regexp_full_match(q, '[\s-]*') THEN 'sin_evidencia' WHEN made_up THEN 'no_encontrada' ELSE 'verificada' END AS name FROM f WHERE lang IS NOT NULL)
SELECT what, name, n FROM (SELECT 'coverage' AS what, 'language' AS name, count(lang) AS n FROM f UNION ALL SELECT 'coverage', 'quality', count(quality) FROM f UNION ALL SELECT 'provenance', 'portal', count(quality) FROM f UNION ALL SELECT 'provenance', 'llm', count(lang) FROM f
UNION ALL SELECT 'verification', name, count(*) FROM v GROUP BY name UNION ALL SELECT 'tokens', 'input', 10*count(*) FROM f UNION ALL SELECT 'tokens', 'output', 3*count(*) FROM f UNION ALL SELECT 'documents', 'all', documents FROM n) WHERE n > 0""")
def q74_extraction_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes are looked for in the whole texts: two of three are from a text's middle, one is made up."""
    middle = F.substring(F.col("text"), F.floor(F.char_length("text") / 2).cast("int") + 1, F.lit(80))
    quote = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("zz"), F.col("doc_id").cast("string"), F.lit("zz"))).otherwise(middle)
    d = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    facts = d.select("doc_id", "text", evidence.extracted(F.col("quality").cast("string"), 1.0, "portal").alias("quality"), evidence.extracted(F.col("lang"), 0.9, "llm", quote).alias("language"), F.lit(10).alias("input_tokens"), F.lit(3).alias("output_tokens"))
    return extraction.coverage_report(facts, ["quality", "language"], "text")


@query("SELECT o_orderpriority AS kind, count(o_orderstatus) AS n, round(count(*) FILTER (o_orderstatus='F')/count(*)::DOUBLE,4) AS f_rate, round(count(*) FILTER (o_orderstatus='O')/count(*)::DOUBLE,4) AS o_rate FROM orders GROUP BY 1")
def q75_outcome_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = indicators.outcome_rates(t(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O"])
    return r.select(F.col("o_orderpriority").alias("kind"), "n", F.round("F_rate", 4).alias("f_rate"), F.round("O_rate", 4).alias("o_rate"))


_N0 = "384.1599999999999"


@query(f"""WITH n AS (SELECT year(o_orderdate) AS y, count(*) AS big FROM orders GROUP BY 1), s AS (SELECT y, big, least(big, ceil({_N0}/(1+({_N0}-1)/big))::BIGINT) AS small FROM n)
SELECT {tables.SEED_SAMPLE} AS seed, 0.05::DOUBLE AS error, 0.95::DOUBLE AS confidence, 0.5::DOUBLE AS p, sum(big)::BIGINT AS total_n, sum(small)::BIGINT AS sampled, count(*)::INT AS strata, min(y)::INT AS since, max(y)::INT AS until, string_agg(y || ':' || big || ':' || small, ',' ORDER BY y) AS sizes, (SELECT count(*) FROM orders) AS census_rows FROM s""")
def q76_sample_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("stratum"))
    d = tables.design(tables.stratified_sample(o, "id", "stratum", tables.SEED_SAMPLE), "stratum", tables.SEED_SAMPLE, 0.05, census=o, key="id")
    sizes = F.transform(F.map_entries("strata"), lambda e: F.concat_ws(":", e["key"], e["value"]["universe"], e["value"]["sampled"]))
    return d.select("seed", "error", "confidence", "p", "total_n", "sampled", F.size("strata").alias("strata"), "since", "until", F.array_join(sizes, ",").alias("sizes"), "census_rows")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE round(greatest(0.0, ((c_custkey % 3)/7.0::DOUBLE + 3.8416/14.0 - 1.96*sqrt((c_custkey % 3)/7.0::DOUBLE*(1-(c_custkey % 3)/7.0::DOUBLE)/7 + 3.8416/196.0))/(1+3.8416/7)),6) END AS low, CASE WHEN c_custkey % 3 = 0 THEN 1.0 ELSE round(least(1.0, ((c_custkey % 3)/7.0::DOUBLE + 3.8416/14.0 + 1.96*sqrt((c_custkey % 3)/7.0::DOUBLE*(1-(c_custkey % 3)/7.0::DOUBLE)/7 + 3.8416/196.0))/(1+3.8416/7)),6) END AS high, CASE WHEN c_custkey % 3 = 0 THEN 'insuficiente' WHEN c_custkey % 3 = 1 THEN 'NO CUMPLE' ELSE 'NO CUMPLE' END AS verdict FROM customer")
def q77_reviewed_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval from nothing reviewed is the whole range, not zero."""
    m = F.col("c_custkey") % 3
    w = stats.wilson(m, F.when(m == 0, 0).otherwise(7), empty=(0.0, 1.0))
    return t(spark, sf_dir, "customer").select("c_custkey", F.round(w["low"], 6).alias("low"), F.round(w["high"], 6).alias("high"), stats.verdict(w["low"], w["high"]).alias("verdict"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'falta' WHEN doc_id % 3 = 1 THEN 'ok' ELSE 'difiere' END AS state FROM documents")
def q78_stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    expected = d.select("doc_id", "path", F.sha2("content", 256).alias("sha256"))
    stored = d.where("doc_id % 3 <> 0").select("path", F.when(F.col("doc_id") % 3 == 2, F.concat("content", F.lit("!").cast("binary"))).otherwise(F.col("content")).alias("content"))
    return readers.verify_blobs(expected, stored).select("doc_id", "state")


@query("SELECT c_custkey, '{\"a\":\"' || c_mktsegment || '\",\"b\":\"' || c_custkey || '\"}' AS canonical, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 12 END AS page FROM customer")
def q79_canonical_and_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.lit("sin marca aquí")).when(k % 3 == 1, F.lit("===PAGINA 1===\naquí ===PAGINA 2===")).otherwise(F.lit("===PAGINA 1===\n===PAGINA 12===\naquí"))
    m = F.create_map(F.lit("b"), k.cast("string"), F.lit("a"), F.col("c_mktsegment"))
    return t(spark, sf_dir, "customer").select("c_custkey", readers.canonical_json(m).alias("canonical"), page_of(text, F.instr(text, "aquí")).alias("page"))


@query(f"""WITH c AS (SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 2 THEN 'sin guion' || o_orderkey WHEN 3 THEN o_orderkey || '-20x' WHEN 4 THEN o_orderkey || '-198' ELSE o_orderkey || '-98' END AS c, o_orderkey % 7 AS m FROM orders)
SELECT c AS "case", CASE m WHEN 2 THEN 'sin guion' WHEN 3 THEN 'no numerico' ELSE 'longitud del anio' END AS reason FROM c WHERE m IN (2,3,4)""")
def q80_underivable_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, m = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 7
    case = F.when(m == 2, F.concat(F.lit("sin guion"), k)).when(m == 3, F.concat(k, F.lit("-20x"))).when(m == 4, F.concat(k, F.lit("-198"))).otherwise(F.concat(k, F.lit("-98")))
    census = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array(case, case).alias("cases"), F.lit("x").alias("kind"), "o_orderdate", F.col("o_orderkey").alias("ord"))
    return tables.underivable_cases(census, AS_OF)
