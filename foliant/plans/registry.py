"""The queries over the driver's tables and their SQL oracles, side by side.

The tables are an order register, not court rulings; each query binds an operator's
columns to them. Doubles are rounded to four places, as the rates are.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import ruling, rules, stats, textquality
from foliant.functions.text import first_present
from foliant.operators import evidence, extraction, indicators, tables
from foliant.plans import chain, flow, parsers, search, surface  # noqa: F401  (they register their queries)
from foliant.plans.base import AS_OF, ORACLES, QUERIES, query, spread, t
from foliant.sources import readers
from foliant.streaming import incremental

__all__ = ["ORACLES", "QUERIES"]


# order years are 1992-1998; four study periods over them
PERIODS = [("1992-1993", 1992, 1993), ("1994-1995", 1994, 1995), ("1996-1997", 1996, 1997), ("1998-2001", 1998, 2001)]
PERIOD_SQL = "CASE " + " ".join(f"WHEN year(o_orderdate) BETWEEN {a} AND {b} THEN '{p}'" for p, a, b in PERIODS) + " END"


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", tables.period_of(F.year("o_orderdate"), PERIODS).alias("period"))
    effect = F.when(F.col("l_returnflag") == "R", "altera").when(F.col("l_returnflag") == "A", "mantiene")
    rule = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1), ruling.DISPUTED)
    return t(spark, sf_dir, "lineitem").select("l_orderkey", effect.alias("effect"), rule.alias("rule")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def _with_intervals(r: DataFrame) -> DataFrame:
    b, s = stats.wilson(F.col("broad"), F.col("n")), stats.wilson(F.col("strict"), F.col("n"))
    r4 = lambda c, name: F.round(c, 4).alias(name)
    return r.select("period", "n", "broad", "strict", r4(b["rate"], "broad_rate"), r4(b["low"], "broad_low"), r4(b["high"], "broad_high"), r4(s["rate"], "strict_rate"), r4(s["low"], "strict_low"), r4(s["high"], "strict_high"))


def _wilson_sql(k: str, n: str, side: str) -> str:
    z = "1.96"
    half = f"{z}*sqrt(({k}/{n}::DOUBLE)*(1-{k}/{n}::DOUBLE)/{n}+{z}*{z}/(4.0*{n}*{n}))"
    centre, scale = f"({k}/{n}::DOUBLE+{z}*{z}/(2.0*{n}))", f"(1+{z}*{z}/{n}::DOUBLE)"
    return f"greatest(0.0,({centre}-{half})/{scale})" if side == "low" else f"least(1.0,({centre}+{half})/{scale})"


_DECISIONS_SQL = f"SELECT {PERIOD_SQL} AS period, CASE l_returnflag WHEN 'R' THEN 'altera' WHEN 'A' THEN 'mantiene' END AS effect, CASE WHEN l_returnflag='R' AND l_linestatus='F' AND l_linenumber=1 THEN '{ruling.DISPUTED}' END AS rule FROM lineitem JOIN orders ON l_orderkey=o_orderkey"
_RATES_SQL = f"""WITH d AS ({_DECISIONS_SQL}), r AS (SELECT period, count(*) AS n, count(*) FILTER (effect='altera') AS broad, count(*) FILTER (effect='altera' AND coalesce(rule,'')<>'{ruling.DISPUTED}') AS strict
FROM d WHERE effect IN ('altera','mantiene') AND period IS NOT NULL GROUP BY %s)
SELECT period, n, broad, strict, round(broad/n::DOUBLE,4) AS broad_rate, round({_wilson_sql("broad", "n", "low")},4) AS broad_low, round({_wilson_sql("broad", "n", "high")},4) AS broad_high,
round(strict/n::DOUBLE,4) AS strict_rate, round({_wilson_sql("strict", "n", "low")},4) AS strict_low, round({_wilson_sql("strict", "n", "high")},4) AS strict_high FROM r"""


@query(_RATES_SQL % "period")
def q01_rates_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_intervals(tables.rates(_decisions(spark, sf_dir), "period", "effect", "rule", ruling.DISPUTED))


@query(_RATES_SQL % "ROLLUP (period)")
def q29_rollup_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_intervals(tables.rates(_decisions(spark, sf_dir), "period", "effect", "rule", ruling.DISPUTED, total=True))


# case numbers of several shapes from order keys
_CASE_SQL = "CASE o_orderkey % 7 WHEN 0 THEN o_orderkey || '-' || right(year(o_orderdate)::VARCHAR,2) WHEN 1 THEN ' ' || o_orderkey || '-' || year(o_orderdate) || ' ' WHEN 2 THEN 'sin guion' || o_orderkey WHEN 3 THEN o_orderkey || '-20x' WHEN 4 THEN o_orderkey || '-198' ELSE o_orderkey || '-' || year(o_orderdate) END"


def _case() -> Column:
    k, y = F.col("o_orderkey").cast("string"), F.year("o_orderdate").cast("string")
    m = F.col("o_orderkey") % 7
    return F.when(m == 0, F.concat(k, F.lit("-"), F.right(y, F.lit(2)))).when(m == 1, F.concat(F.lit(" "), k, F.lit("-"), y, F.lit(" "))).when(m == 2, F.concat(F.lit("sin guion"), k)).when(m == 3, F.concat(k, F.lit("-20x"))).when(m == 4, F.concat(k, F.lit("-198"))).otherwise(F.concat(k, F.lit("-"), y))


def _year_sql(c: str) -> str:
    tail = f"CASE WHEN contains({c},'-') THEN trim(split_part(trim({c}),'-',-1)) ELSE trim({c}) END"
    n = f"CASE length({tail}) WHEN 4 THEN try_cast({tail} AS INT) WHEN 2 THEN try_cast({tail} AS INT) + CASE WHEN try_cast({tail} AS INT)>=80 THEN 1900 ELSE 2000 END END"
    return f"CASE WHEN contains({c},'-') AND regexp_full_match({tail},'[0-9]+') AND length({tail}) IN (2,4) AND {n} BETWEEN 1986 AND {AS_OF + 1} THEN {n} END"


def _census(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    two = F.array(_case(), F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.right((F.year("o_orderdate") + F.col("o_orderkey") % 3).cast("string"), F.lit(2))))
    return o.select(F.col("o_orderkey").alias("id"), two.alias("cases"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("kind"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("decided"), F.col("o_orderkey").alias("ord"))


_CENSUS_SQL = f"c AS (SELECT o_orderkey AS id, {_CASE_SQL} AS a, o_custkey || '-' || right((year(o_orderdate) + o_orderkey % 3)::VARCHAR,2) AS b, nullif(o_orderpriority,'5-LOW') AS kind, CASE WHEN o_orderstatus<>'P' THEN o_orderdate END AS decided FROM orders), e AS (SELECT id, unnest([a,b]) AS c1, unnest([1,2]) AS i FROM c), y AS (SELECT id, c1, i, {_year_sql('c1')} AS year FROM e)"


@query(f"WITH {_CENSUS_SQL} SELECT (SELECT count(*) FROM c) AS documents, (SELECT count(DISTINCT c1) FROM e) AS cases, (SELECT count(*) FROM c WHERE decided IS NULL) AS missing_date, (SELECT count(*) FROM (SELECT DISTINCT c1 FROM y WHERE year IS NULL)) AS underivable, (SELECT count(DISTINCT year) FROM y) AS years, (SELECT count(DISTINCT coalesce(kind,'(sin tipo)')) FROM c) AS kinds, (SELECT count(*) FROM (SELECT DISTINCT id, year FROM y WHERE year IS NOT NULL)) AS document_years")
def q02_census_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tables.census_summary(_census(spark, sf_dir), AS_OF)
    return s.select("documents", "cases", "missing_date", "underivable", F.size("by_year").cast("long").alias("years"), F.size("by_kind").cast("long").alias("kinds"), F.aggregate(F.map_values("by_year"), F.lit(0).cast("long"), lambda a, x: a + x).alias("document_years"))


@query(f"""WITH {_CENSUS_SQL} SELECT 'each' AS policy, year, count(DISTINCT id) AS documents FROM y WHERE year IS NOT NULL GROUP BY year
UNION ALL SELECT 'first', year, count(*) FROM (SELECT id, arg_min(year, i) AS year FROM y WHERE year IS NOT NULL GROUP BY id) GROUP BY year
UNION ALL SELECT 'oldest', year, count(*) FROM (SELECT id, min(year) AS year FROM y WHERE year IS NOT NULL GROUP BY id) GROUP BY year
UNION ALL SELECT 'first_case', year, count(*) FROM y WHERE i=1 AND year IS NOT NULL GROUP BY year""")
def q03_year_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.by_year(_census(spark, sf_dir), AS_OF, "each", "first", "oldest", "first_case")


_N0 = "384.1599999999999"
_SAMPLE_SQL = f"o AS (SELECT o_orderkey AS id, year(o_orderdate) AS stratum, o_totalprice FROM orders), n AS (SELECT stratum, count(*) AS stratum_n, least(count(*), ceil({_N0}/(1+({_N0}-1)/count(*)))::BIGINT) AS sample_n FROM o GROUP BY stratum), s AS (SELECT o.*, stratum_n, sample_n FROM o JOIN n USING (stratum) QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY md5('{tables.SEED_SAMPLE}:' || stratum || ':' || id), id::VARCHAR) <= sample_n)"


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("stratum"), "o_totalprice")
    return tables.stratified_sample(o, "id", "stratum", tables.SEED_SAMPLE)


@query(f"WITH {_SAMPLE_SQL} SELECT id, stratum, stratum_n, sample_n FROM s")
def q04_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).select("id", "stratum", "stratum_n", "sample_n")


@query(f"SELECT o_orderkey AS id, {PERIOD_SQL} AS period FROM orders WHERE {PERIOD_SQL} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {PERIOD_SQL} ORDER BY md5('{tables.SEED_STUDY}:' || {PERIOD_SQL} || ':' || o_orderkey), o_orderkey::VARCHAR) <= 500")
def q05_quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), tables.period_of(F.year("o_orderdate"), PERIODS).alias("period")).where("period is not null")
    return tables.quota_sample(o, "id", "period", tables.SEED_STUDY, 500).select("id", "period")


_STRIP = "translate({}, '" + "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ" + "', '" + "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY" + "')"
_in = lambda words: ", ".join(f"'{w}'" for w in words)
_LOST_SQL = " || ".join(f"CASE WHEN letters>=500 AND letters-length(replace(flat,'{x}','')) < 0.15*{p}/100*letters THEN '{x}' ELSE '' END" for x, p in sorted(textquality.LETTERS.items()))
_QUALITY_SQL = f"""a AS (SELECT doc_id, lower(replace(text, chr(12), ' ')) AS t FROM documents), b AS (SELECT doc_id, length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) AS chars, regexp_extract_all(t, '[a-záéíóúüñ]+') AS words, regexp_replace(strip_accents(t), '[^a-z]+', '', 'g') AS flat FROM a),
d AS (SELECT *, len(words) AS n, length(flat) AS letters, len(list_filter(words, lambda w: w IN ({_in(textquality.FUNCTION_WORDS)})))/nullif(len(words),0)::DOUBLE AS fr, len(list_filter(words, lambda w: (length(w)=1 AND w NOT IN ({_in(textquality.ONE_LETTER)})) OR (length(w)=2 AND w NOT IN ({_in(textquality.TWO_LETTERS)}))))/nullif(len(words),0)::DOUBLE AS gr FROM b),
q AS (SELECT doc_id, chars, n AS tokens, chars<200 OR n<30 AS bare, fr, gr, {_LOST_SQL} AS lost FROM d),
r AS (SELECT doc_id, CASE WHEN bare THEN 'sin_capa_de_texto' WHEN lost<>'' OR fr<0.18 OR gr>0.12 THEN 'sospechoso' ELSE 'usable' END AS verdict, chars, tokens, CASE WHEN bare THEN 0 ELSE round(fr,4) END AS function_ratio, CASE WHEN bare THEN 0 ELSE round(gr,4) END AS fragment_ratio, CASE WHEN bare THEN '' ELSE lost END AS lost FROM q)"""


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = textquality.assess(spread(t(spark, sf_dir, "documents").select("doc_id", "text")), "text", "q")
    return q.select("doc_id", "q.verdict", "q.chars", "q.tokens", F.round("q.function_ratio", 4).alias("function_ratio"), F.round("q.fragment_ratio", 4).alias("fragment_ratio"), F.concat_ws("", "q.lost_letters").alias("lost"))


@query(f"WITH {_QUALITY_SQL} SELECT doc_id, verdict, chars, tokens, function_ratio::DOUBLE AS function_ratio, fragment_ratio::DOUBLE AS fragment_ratio, lost FROM r")
def q06_text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality(spark, sf_dir)


@query(f"""WITH {_QUALITY_SQL}, v AS (SELECT verdict AS stratum, count(*) AS size FROM r GROUP BY verdict), w AS (SELECT verdict AS stratum, count(*) AS n, count(*) FILTER ((verdict='usable')=(quality=1)) AS k FROM r JOIN labels USING (doc_id) GROUP BY verdict),
x AS (SELECT coalesce(sum(n),0)::BIGINT AS n, coalesce(sum(k),0)::BIGINT AS k, sum(coalesce(k/n::DOUBLE*size,0))/sum(size) AS weighted FROM v LEFT JOIN w USING (stratum))
SELECT n, k, round(weighted,4) AS weighted, round({_wilson_sql('k', 'n', 'low')},4) AS low, round({_wilson_sql('k', 'n', 'high')},4) AS high, CASE WHEN {_wilson_sql('k', 'n', 'low')}>0.95 THEN 'CUMPLE' WHEN {_wilson_sql('k', 'n', 'high')}<0.95 THEN 'NO CUMPLE' ELSE 'insuficiente' END AS verdict FROM x""")
def q07_quality_vs_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quality(spark, sf_dir).select("doc_id", F.col("verdict").alias("stratum"))
    reviewed = q.join(t(spark, sf_dir, "labels"), "doc_id").select("stratum", ((F.col("stratum") == "usable") == (F.col("quality") == 1)).alias("right"))
    a = tables.weighted_accuracy(reviewed, q.groupBy("stratum").agg(F.count("*").alias("size")))
    w = stats.wilson(F.col("k"), F.col("n"))
    return a.select("n", "k", F.round("weighted", 4).alias("weighted"), F.round(w["low"], 4).alias("low"), F.round(w["high"], 4).alias("high"), stats.verdict(w["low"], w["high"]).alias("verdict"))


def _quotable_sql(c: str) -> str:
    return f"regexp_replace(trim(regexp_replace(lower({_STRIP.format(c)}), '\\s+', ' ', 'g')), '\\s*-\\s*', '-', 'g')"


@query(f"SELECT doc_id, item_id, 'verificada' AS status FROM (SELECT doc_id, {_quotable_sql('text')} AS d FROM documents) JOIN (SELECT item_id, {_quotable_sql('text')} AS q FROM benchmark) ON contains(d, q)")
def q08_quote_in_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.quotes_in(spread(t(spark, sf_dir, "documents").select("doc_id", "text")), t(spark, sf_dir, "benchmark"), "doc_id", "item_id").withColumn("status", F.lit("verificada"))


_PART_RULES = rules.RuleSet((("Metal", r"brass|steel"), ("Precious", r"copper|nickel"), ("Tin", r"tin"), ("Promo", r"\bpromo")), "Other", "Blank")
_L, _FR = _PART_RULES.sql("lower(p_type)")


@query(f"SELECT label, fragment, count(*) AS n FROM (SELECT {_L} AS label, {_FR} AS fragment FROM part) GROUP BY ALL")
def q09_rule_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select(_PART_RULES.classify(F.col("p_type")).alias("c")).groupBy("c.label", "c.fragment").agg(F.count("*").alias("n"))


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.create_map(F.lit("Tema"), F.col("c_mktsegment"), F.lit("Autoridad impugnada"), F.col("c_name"), F.lit("Fallo"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.format_string("%d", F.floor("c_acctbal")))).alias("attributes"))


@query("SELECT field, count(*) AS n, count(*) FILTER (value<>'') AS filled, count(*) FILTER (topic) AS on_topic FROM (SELECT c_custkey, unnest(['Tema','Autoridad impugnada','Fallo']) AS field, unnest([c_mktsegment, c_name, CASE WHEN c_acctbal<0 THEN '' ELSE floor(c_acctbal)::BIGINT::VARCHAR END]) AS value, contains(lower(c_mktsegment),'build') AS topic FROM customer) GROUP BY field")
def q13_attributes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cards(spark, sf_dir).withColumn("topic", evidence.topic_occurs(F.col("attributes"), "BUILD"))
    long = c.select("id", "topic", F.explode("attributes").alias("field", "value"))
    return long.groupBy("field").agg(F.count("*").alias("n"), F.count_if(F.col("value") != "").alias("filled"), F.count_if("topic").alias("on_topic"))


@query("SELECT o_orderpriority AS label, count(*) FILTER (l_returnflag='R') AS altera, count(*) FILTER (l_returnflag='A') AS mantiene FROM orders JOIN lineitem ON l_orderkey=o_orderkey GROUP BY 1")
def q14_label_effect_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    effect = F.when(F.col("l_returnflag") == "R", "altera").when(F.col("l_returnflag") == "A", "mantiene")
    l = t(spark, sf_dir, "lineitem").select("l_orderkey", effect.alias("effect"))  # noqa: E741
    j = l.join(t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("label")), "l_orderkey")
    return tables.crosstab(j, "label", "effect", ["altera", "mantiene"])


@query("""WITH d AS (SELECT l_shipmode2 AS g, count(*) FILTER (f='R') AS a, count(*) FILTER (f='A') AS b FROM (SELECT CASE WHEN l_linenumber<=3 THEN 'head' ELSE 'tail' END AS l_shipmode2, l_returnflag AS f FROM lineitem) GROUP BY 1),
x AS (SELECT h.a, h.b, t.a AS c, t.b AS d FROM d h, d t WHERE h.g='head' AND t.g='tail')
SELECT a, b, c, d, round((a+b+c+d)*power((a*d-b*c)::DOUBLE,2)/((a+b)::DOUBLE*(c+d)*(a+c)*(b+d)),4) AS x2, (a+b+c+d)*power((a*d-b*c)::DOUBLE,2)/((a+b)::DOUBLE*(c+d)*(a+c)*(b+d)) > 3.841459 AS differs FROM x""")
def q15_chi2_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.col("l_linenumber") <= 3
    n = lambda g, f, name: F.count_if(g & (F.col("l_returnflag") == f)).alias(name)
    x = t(spark, sf_dir, "lineitem").agg(n(head, "R", "a"), n(head, "A", "b"), n(~head, "R", "c"), n(~head, "A", "d"))
    x2 = stats.chi_square(*[F.col(c) for c in "abcd"])
    return x.select("a", "b", "c", "d", F.round(x2, 4).alias("x2"), (x2 > 3.841459).alias("differs"))


_STATE_SQL = "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("at"))


@query(f"SELECT event_type, count(*) AS users FROM ({_STATE_SQL}) GROUP BY event_type")
def q17_latest_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest(_log(spark, sf_dir), "user_id", "event_type", "at").groupBy("event_type").agg(F.count("*").alias("users"))


@query(f"SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ({_STATE_SQL}) WHERE event_type IN ('purchase','click'))")
def q18_resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = tables.done_keys(_log(spark, sf_dir), "user_id", "event_type", "at", ["purchase", "click"])
    return tables.pending(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")), done, "user_id")


_TITLE_SQL = r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1)"
for _entity, _character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
    _TITLE_SQL = f"replace({_TITLE_SQL}, '{_entity}', '{_character}')"


@query(rf"WITH x AS (SELECT page_id, trim(regexp_replace({_TITLE_SQL}, '\s+', ' ', 'g')) AS x FROM pages) SELECT page_id, nullif(x, '') AS title, nullif(x, '') AS label, '' AS blank FROM x")
def q20_html_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    title = readers.html_text(readers.html_field(F.col("html"), "title"))
    card = F.concat(F.lit("<table><tr><th>T&iacute;tulo</th><td>"), F.coalesce(readers.html_field(F.col("html"), "title"), F.lit("")), F.lit("</td></tr><tr><td>Vac&iacute;o</td></tr></table>"))
    return p.select("page_id", title.alias("title"), readers.html_card(card).alias("card")).select("page_id", "title", first_present(F.col("card"), "Fallo", "Título").alias("label"), F.col("card")["Vacío"].alias("blank"))


@query("SELECT doc_id, sha256(coalesce(text,'')) AS sha256, substr(sha256('src:' || doc_id),1,16) AS record_id, source || '/' || coalesce(lang,'unknown') || '/' || sha256(coalesce(text,'')) || '.txt' AS path FROM documents")
def q22_record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return t(spark, sf_dir, "documents").select("doc_id", digest.alias("sha256"), evidence.record_id("src", F.col("doc_id")).alias("record_id"), evidence.raw_path(F.col("source"), F.col("lang"), digest, F.lit("txt")).alias("path"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    portal = evidence.extracted(F.col("quality").cast("string"), 1.0, "portal")
    ruled = evidence.extracted(F.when(F.contains("text", F.lit("|")), "0"), 0.8, "deterministic", F.col("text"))
    middle = F.substring(F.col("text"), F.floor(F.char_length("text") / 2).cast("int") + 1, F.lit(60))
    answer = F.struct(F.lit("1").alias("value"), F.when(F.col("doc_id") % 4 != 0, middle).alias("quote"), F.lit(1).alias("page"), F.when(F.col("doc_id") % 4 == 1, 0.2).otherwise(0.9).alias("confidence"))
    said = extraction.said(answer, least=0.5)
    return d.select("doc_id", "text", evidence.layered(portal, ruled, said).alias("quality"), evidence.extracted(F.col("lang"), 0.95, "deterministic").alias("language"))


_FACT_SQL = """f AS (SELECT doc_id, text, CASE WHEN quality IS NOT NULL THEN quality::VARCHAR WHEN contains(text,'|') THEN '0' WHEN doc_id%4 IN (2,3) AND NOT regexp_full_match(substr(text,length(text)//2+1,60),'[\\s\\x0B\\x1C-\\x1F]*') THEN '1' END AS value,
CASE WHEN quality IS NOT NULL THEN 'portal' WHEN contains(text,'|') THEN 'deterministic' WHEN doc_id%4 IN (2,3) AND NOT regexp_full_match(substr(text,length(text)//2+1,60),'[\\s\\x0B\\x1C-\\x1F]*') THEN 'llm' END AS provenance, CASE WHEN quality IS NOT NULL THEN 1.0 WHEN contains(text,'|') THEN 0.8 ELSE 0.9 END AS confidence FROM documents LEFT JOIN labels USING (doc_id))"""


@query(f"WITH {_FACT_SQL} SELECT doc_id, value, provenance, confidence::DOUBLE AS confidence, 'verificada' AS status FROM f WHERE value IS NOT NULL")
def q23_layered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _facts(spark, sf_dir).where("quality.value is not null")
    return f.select("doc_id", "quality.value", "quality.provenance", "quality.confidence", evidence.verify_quote(F.col("quality"), F.col("text")).alias("status"))


@query(f"WITH {_FACT_SQL} SELECT 'quality' AS field, provenance, count(*) AS n, (SELECT count(*) FROM documents) AS documents FROM f WHERE value IS NOT NULL GROUP BY provenance UNION ALL SELECT 'language', 'deterministic', count(*), (SELECT count(*) FROM documents) FROM documents WHERE lang IS NOT NULL")
def q24_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = evidence.facts_long(_facts(spark, sf_dir), "doc_id", ["quality", "language"]).groupBy("field", "provenance").agg(F.count("*").alias("n"))
    return long.crossJoin(t(spark, sf_dir, "documents").agg(F.count("*").alias("documents")))  # one row


@query(f"WITH {_SAMPLE_SQL} SELECT round(sum(CASE WHEN o_totalprice>200000 THEN stratum_n/sample_n::DOUBLE ELSE 0 END),2) AS estimate, count(*) FILTER (o_totalprice>200000) AS hits, count(*) AS sampled FROM s")
def q25_weighted_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.weighted_total(_sample(spark, sf_dir), F.col("o_totalprice") > 200000).select(F.round("estimate", 2).alias("estimate"), "hits", "sampled")


@query(f"""WITH {_FACT_SQL} SELECT 'census' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'attributes', 3*count(*) FROM customer UNION ALL SELECT 'decisions', count(*) FROM lineitem WHERE l_returnflag IN ('R','A')
UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'extractions', (SELECT count(*) FROM f WHERE value IS NOT NULL) + (SELECT count(*) FROM documents WHERE lang IS NOT NULL) UNION ALL SELECT 'judicial_officers', 0 UNION ALL SELECT 'appeal_links', 0 UNION ALL SELECT 'citations', 0""")
def q26_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = _decisions(spark, sf_dir).select(F.col("l_orderkey").alias("id"), "effect", "rule", "period")
    facts = evidence.facts_long(_facts(spark, sf_dir), "doc_id", ["quality", "language"])
    return evidence.load_report(evidence.load_model(_census(spark, sf_dir), _cards(spark, sf_dir), decisions, t(spark, sf_dir, "documents"), facts))


@query("SELECT o_orderpriority AS kind, count(*) AS n, quantile_cont(d,0.25) AS p25, quantile_cont(d,0.5) AS p50, quantile_cont(d,0.75) AS p75, quantile_cont(d,0.9) AS p90 FROM (SELECT o_orderpriority, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS d FROM orders JOIN lineitem ON l_orderkey=o_orderkey) GROUP BY 1")
def q27_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    d = F.datediff("l_shipdate", "o_orderdate")
    j = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    r = j.groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("n"), F.percentile(d, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75, 0.9)])).alias("p"))
    return r.select("kind", "n", *[F.col("p")[i].alias(f"p{q}") for i, q in enumerate((25, 50, 75, 90))])


@query("SELECT c_mktsegment AS universe, count(DISTINCT c_custkey) FILTER (c_name LIKE '%7') AS parties, count(o_orderkey) FILTER (c_name LIKE '%7') AS hits, count(o_orderkey) AS documents FROM customer LEFT JOIN orders ON o_custkey=c_custkey GROUP BY 1")
def q28_party_search_denominator(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    j = t(spark, sf_dir, "customer").join(orders, "c_custkey", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    hit = F.col("c_name").endswith("7")
    return j.groupBy(F.col("c_mktsegment").alias("universe")).agg(F.count_if(hit).alias("parties"), F.sum(F.when(hit, F.col("k")).otherwise(0)).alias("hits"), F.sum("k").alias("documents"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events FROM events GROUP BY event_type")
def q30_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file stream, in one run to the end and one more that finds nothing new."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    base = f"{(folder or 'file://' + tempfile.mkdtemp(prefix='foliant-')).rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = t(spark, sf_dir, "events").schema
    for _ in range(2):
        incremental.append_new(spark, sf_dir, schema, f"{base}/events", f"{base}/checkpoint", "event_id", only="events.parquet")
    return incremental.appended(spark, schema, f"{base}/events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"))



def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag").join(o, "l_orderkey")


@query("""WITH e AS (SELECT date_trunc('month', o_orderdate::DATE)::DATE AS period, 1 AS f, 0 AS d FROM lineitem JOIN orders ON l_orderkey=o_orderkey UNION ALL SELECT date_trunc('month', l_shipdate::DATE)::DATE, 0, 1 FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
p AS (SELECT period, sum(f)::BIGINT AS filed, sum(d)::BIGINT AS decided FROM e GROUP BY 1) SELECT period, filed, decided, sum(filed-decided) OVER (ORDER BY period)::BIGINT AS backlog FROM p""")
def q31_load_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.load(_lines(spark, sf_dir), "o_orderdate", "l_shipdate")


@query(f"""WITH r AS (SELECT o_orderpriority AS kind, count(*) AS reviewed, count(*) FILTER (l_returnflag='A') AS kept FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_returnflag IN ('R','A') GROUP BY 1)
SELECT kind, reviewed, kept, round(kept/reviewed::DOUBLE,4) AS rate, round({_wilson_sql('kept', 'reviewed', 'low')},4) AS low, round({_wilson_sql('kept', 'reviewed', 'high')},4) AS high FROM r""")
def q32_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    effect = F.when(F.col("l_returnflag") == "R", "altera").when(F.col("l_returnflag") == "A", "mantiene")
    j = t(spark, sf_dir, "lineitem").select("l_orderkey", effect.alias("effect")).where("effect is not null").join(t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("kind")), "l_orderkey")
    return indicators.stability(j, ["kind"], "effect").select("kind", "reviewed", "kept", *[F.round(c, 4).alias(c) for c in ("rate", "low", "high")])


@query(f"""WITH p AS (SELECT o_orderpriority AS peer_group, l_suppkey AS unit, count(*) AS n, count(*) FILTER (l_returnflag='R') AS k FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY 1,2), b AS (SELECT *, sum(k) OVER (PARTITION BY peer_group)/(sum(n) OVER (PARTITION BY peer_group))::DOUBLE AS baseline FROM p),
s AS (SELECT *, CASE WHEN n>=30 THEN baseline < {_wilson_sql('k', 'n', 'low')} OR baseline > {_wilson_sql('k', 'n', 'high')} END AS signal FROM b),
c AS (SELECT o_orderpriority AS peer_group, l_suppkey AS unit, list_sort(list(DISTINCT l_orderkey))[1:20] AS ids FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_returnflag='R' GROUP BY 1,2)
SELECT peer_group, unit, n, k, round(k/n::DOUBLE,4) AS rate, round(baseline,4) AS baseline, round(k/n::DOUBLE-baseline,4) AS difference, signal, CASE WHEN signal THEN array_to_string(ids, ',') END AS cases FROM s LEFT JOIN c USING (peer_group, unit)""")
def q33_peer_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = indicators.peers(_lines(spark, sf_dir), "l_suppkey", "o_orderpriority", F.col("l_returnflag") == "R", "l_orderkey")
    return r.select("peer_group", "unit", "n", "k", *[F.round(c, 4).alias(c) for c in ("rate", "baseline", "difference")], "signal", F.when(F.col("cases").isNotNull(), F.concat_ws(",", "cases")).alias("cases"))


def _ranked_sql(stratum: str, size: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {stratum} ORDER BY md5('{tables.SEED_STUDY}:' || {stratum} || ':' || id), id::VARCHAR) <= {size}"


@query(f"""WITH r AS (SELECT o_orderkey AS id, 'random' AS reason FROM orders UNION ALL SELECT o_orderkey, 'low_value' FROM orders WHERE o_totalprice<20000 UNION ALL SELECT o_orderkey, 'pending' FROM orders WHERE o_orderstatus='P') SELECT id, reason FROM r {_ranked_sql('reason', '50')}""")
def q34_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice", "o_orderstatus")
    return indicators.review_sample(o, "id", tables.SEED_STUDY, 50, {"low_value": F.col("o_totalprice") < 20000, "pending": F.col("o_orderstatus") == "P"}).select("id", "reason")


@query(f"SELECT id, stratum FROM (SELECT o_orderkey AS id, o_orderstatus AS stratum FROM orders) {_ranked_sql('stratum', '''CASE stratum WHEN 'F' THEN 40 ELSE 30 END''')}")
def q35_plan_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("stratum"))
    return tables.plan_sample(o, "id", "stratum", tables.SEED_STUDY, {"F": 40, "O": 30, "P": 30}).select("id", "stratum")


@query("SELECT year(o_orderdate) AS year, count(*) AS n, count(nullif(o_orderpriority,'5-LOW')) AS kind, count(*) FILTER (o_orderstatus<>'P') AS decided, round(100*count(nullif(o_orderpriority,'5-LOW'))/count(*)::DOUBLE,1) AS kind_pct, round(100*(count(*) FILTER (o_orderstatus<>'P'))/count(*)::DOUBLE,1) AS decided_pct FROM orders GROUP BY 1")
def q36_coverage_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("kind"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("decided"))
    return tables.coverage(o, "year", "kind", "decided")


@query("SELECT field, count(*) AS n FROM (SELECT 'segment' AS field, c_mktsegment AS value FROM customer UNION ALL SELECT 'name', c_name FROM customer) WHERE contains(lower(value),'er') GROUP BY 1")
def q37_term_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    return tables.term_fields(t(spark, sf_dir, "customer").select(card.alias("card")), "card", "ER")


@query("SELECT doc_id, 'f/' || doc_id AS path, n_chars::BIGINT AS size FROM documents WHERE n_chars > 0 AND n_chars = strlen(text)")
def q38_reusable_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("f/"), F.col("doc_id")).alias("path"), F.col("n_chars").cast("long").alias("size"))
    # every document was downloaded before, with as many bytes as it has characters: those with other letters than ASCII have another size by now
    files = t(spark, sf_dir, "documents").select(F.concat(F.lit("f/"), F.col("doc_id")).alias("path"), F.octet_length("text").cast("long").alias("length"))
    return tables.reusable(d.select("doc_id"), d, files, "doc_id")


@query("""WITH s AS (SELECT o_orderpriority AS a, year(o_orderdate) AS b, count(*) FILTER (o_orderstatus='F') AS n1, count(*) FILTER (o_orderstatus='F' AND o_totalprice>150000) AS k1, count(*) FILTER (o_orderstatus<>'F') AS n0, count(*) FILTER (o_orderstatus<>'F' AND o_totalprice>150000) AS k0 FROM orders GROUP BY 1,2 HAVING n1>0 AND n0>0)
SELECT count(*) AS strata, sum(n1)::BIGINT AS treated, sum(n0)::BIGINT AS others, round(sum(k1)/sum(n1)::DOUBLE,4) AS treated_rate, round(sum(n1*k0/n0::DOUBLE)/sum(n1)::DOUBLE,4) AS matched_rate FROM s""")
def q39_matched_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    r = indicators.matched_difference(o, ["o_orderpriority", "y"], F.col("o_orderstatus") == "F", F.col("o_totalprice") > 150000)
    return r.select("strata", "treated", "others", *[F.round(c, 4).alias(c) for c in ("treated_rate", "matched_rate")])


@query("SELECT c_custkey AS id, o_orderkey + 1000000000 AS linked, CASE WHEN o_orderkey % 3 = 0 THEN 'case' ELSE 'party' END AS signal FROM orders JOIN customer ON o_custkey=c_custkey")
def q40_linked_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda c: F.concat(F.lit("k"), F.col(c))
    left = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), key("c_custkey").alias("case"), key("c_custkey").alias("party"))
    right = t(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1000000000).alias("linked"), F.when(F.col("o_orderkey") % 3 == 0, key("o_custkey")).alias("case"), key("o_custkey").alias("party"))
    return indicators.linked(left, right, "id", "linked", [("case", "case", "case"), ("party", "party", "party")]).select("id", "linked", "signal")


@query("""WITH b AS (SELECT o_orderkey AS id, o_orderkey % 3 AS m, (o_custkey % 9999)::VARCHAR || '-' || year(o_orderdate)::VARCHAR AS c FROM orders)
SELECT id, 'case' AS field, c AS value, 'deterministic' AS provenance, 0.95::DOUBLE AS confidence, 2 AS page FROM b UNION ALL SELECT id, 'kind', CASE m WHEN 0 THEN 'Amparo' ELSE 'Apelación De Sentencia De Amparo' END, CASE m WHEN 0 THEN 'portal' ELSE 'deterministic' END, CASE m WHEN 0 THEN 1.0 ELSE 0.8 END, CASE m WHEN 0 THEN NULL ELSE 1 END FROM b
UNION ALL SELECT id, 'court', 'Sala Tercera de lo Civil', 'deterministic', 0.85, 2 FROM b UNION ALL SELECT id, 'outcome', CASE m WHEN 1 THEN 'revocado' ELSE 'confirmado' END, CASE m WHEN 1 THEN 'portal' ELSE 'llm' END, CASE m WHEN 1 THEN 0.97 ELSE 0.9 END, CASE m WHEN 1 THEN NULL ELSE 3 END FROM b
UNION ALL SELECT id, 'effect', CASE m WHEN 1 THEN 'altera_decision_inferior' ELSE 'mantiene_decision_inferior' END, 'deterministic', CASE m WHEN 1 THEN 0.97 ELSE 0.9 END, CASE m WHEN 1 THEN NULL ELSE 3 END FROM b WHERE m <> 0""")
def q41_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("o_orderkey") % 3
    case = F.concat((F.col("o_custkey") % 9999).cast("string"), F.lit("-"), F.year("o_orderdate").cast("string"))
    text = F.concat(F.lit("===PAGINA 1===\nAPELACIÓN DE SENTENCIA DE AMPARO\n===PAGINA 2===\nExpediente No. "), case, F.lit(": se examina la sentencia dictada por la Sala  Tercera de lo Civil, constituida en tribunal."))
    card = F.create_map(F.lit("Materia"), F.when(m == 0, "Amparo").otherwise(" "), F.lit("Fallo"), F.when(m == 1, "Revoca - otorga").otherwise(""))
    none = "named_struct('value', cast(null as string), 'quote', cast(null as string), 'page', 0, 'confidence', cast(0.9 as double))"
    answers = F.expr(f"named_struct('filed', {none}, 'court', {none}, 'outcome', named_struct('value', 'se confirma la sentencia', 'quote', 'la sentencia', 'page', 3, 'confidence', cast(0.9 as double)))")
    d = extraction.with_model(extraction.by_rule(spread(t(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("id"), text.alias("text"), card.alias("card"), answers.alias("answers"))), "answers")
    return evidence.facts_long(d, "id", ["case", "kind", "court", "outcome", "effect"]).select("id", "field", "value", "provenance", "confidence", "page")


@query("""WITH b AS (SELECT l_orderkey AS id, l_linenumber AS line, l_returnflag, o_orderdate::DATE + (20*l_linenumber)::INT AS filed, l_shipdate::DATE AS decided FROM lineitem JOIN orders ON l_orderkey=o_orderkey)
SELECT id, line, concat_ws(',', CASE WHEN decided < filed THEN 'resuelto antes de presentado' END, CASE WHEN line = 3 THEN 'numero con otra forma' END) AS failed, round(((decided >= filed)::INT + (line <> 3)::INT + (l_returnflag='R')::INT)/3.0::DOUBLE,4) AS confidence FROM b""")
def q42_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, filed, decided = F.col("l_linenumber"), F.date_add(F.to_date("o_orderdate"), 20 * F.col("l_linenumber").cast("int")), F.to_date("l_shipdate")
    case = F.concat(F.col("l_orderkey").cast("string"), F.when(line == 3, "/98").otherwise("-98"))
    failed = indicators.consistency(filed, decided, case)
    sure = indicators.data_confidence(decided >= filed, ~F.array_contains(failed, "numero con otra forma"), F.col("l_returnflag") == "R")
    return _lines(spark, sf_dir).select(F.col("l_orderkey").alias("id"), line.alias("line"), F.concat_ws(",", failed).alias("failed"), F.round(sure, 4).alias("confidence"))
