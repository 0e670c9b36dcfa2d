"""Operators once more as plain Spark SQL over views and the session's functions, beside the same oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant import sql
from foliant.plans.base import query, spread, t

_ORDERS = """o AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN concat(o_orderkey, '-', right(cast(year(o_orderdate) AS string), 2)) WHEN 1 THEN concat(o_orderkey, '-20x') WHEN 2 THEN cast(o_orderkey AS string) ELSE concat(' ', o_orderkey, '-', year(o_orderdate)) END AS c FROM foliant_orders)"""


def _session(spark: SparkSession, sf_dir: str, *names: str) -> SparkSession:
    sql.register(spark)
    sql.views({f"foliant_{n}": spread(t(spark, sf_dir, n)) for n in names})
    return spark


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderkey % 5 AS m, year(o_orderdate::DATE)::INT AS y FROM orders)
SELECT id, CASE WHEN m IN (0,3,4) THEN y END AS year, CASE m WHEN 1 THEN 'no numerico' WHEN 2 THEN 'sin guion' END AS problem, CASE m WHEN 1 THEN id || '-20x' WHEN 2 THEN id::VARCHAR ELSE id || '-' || y END AS canonical,
CASE m WHEN 0 THEN id || '-' || right(y::VARCHAR,2) || ',' || id || '-' || y WHEN 1 THEN id || '-20x' WHEN 2 THEN id::VARCHAR ELSE id || '-' || y || ',' || id || '-' || right(y::VARCHAR,2) END AS variants FROM o""")
def q94_case_numbers_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, problems, canonical forms and variants of the orders' numbers, by SQL functions."""
    return _session(spark, sf_dir, "orders").sql(f"WITH {_ORDERS} SELECT id, case_year(c) AS year, case_year_problem(c) AS problem, canonical_case(c) AS canonical, array_join(case_variants(c), ',') AS variants FROM o")


@query("""WITH y AS (SELECT CASE WHEN o_orderkey % 5 IN (0,3,4) THEN year(o_orderdate::DATE)::INT END AS year, o_orderpriority AS kind FROM orders)
SELECT year, kind, count(*) AS documents, round(count(*) * 1.0::DOUBLE / (SELECT count(*) FROM y), 6) AS share FROM y GROUP BY ALL""")
def q95_census_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A census by year and kind, with its denominator."""
    s = _session(spark, sf_dir, "orders")
    return s.sql(f"WITH {_ORDERS}, y AS (SELECT case_year(c) AS year, o_orderpriority AS kind FROM o JOIN foliant_orders ON id = o_orderkey), n AS (SELECT count(*) AS all_of FROM y) SELECT year, kind, count(*) AS documents, round(count(*) / any_value(all_of), 6) AS share FROM y CROSS JOIN n GROUP BY year, kind")


@query("""WITH d AS (SELECT doc_id, string_split(coalesce(text,''), chr(10)) AS l FROM documents), p AS (SELECT doc_id, unnest(l) AS content, generate_subscripts(l, 1) AS page, len(l) AS pages FROM d)
SELECT doc_id, page::INT AS page, sha256(content) AS digest FROM p WHERE NOT (page = pages AND regexp_full_match(content, '[\\s\\x1C-\\x1F\\x0B]*'))""")
def q96_pages_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines as pages, by a table function; a blank last one goes."""
    s = _session(spark, sf_dir, "documents")
    return s.sql("SELECT doc_id, page, sha2(content, 256) AS digest FROM (SELECT doc_id, translate(coalesce(text, ''), char(10), char(12)) AS x FROM foliant_documents) d, LATERAL pages_of(d.x) p")


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderkey % 3 AS m, (o_custkey % 9999) || '-' || year(o_orderdate::DATE) AS c FROM orders)
SELECT id, c AS "case", 2 AS page, CASE m WHEN 0 THEN 'con_lugar' WHEN 1 THEN 'denegado' END AS outcome FROM o""")
def q97_facts_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case number that a page-marked text names, its page, and the outcome that its card words."""
    s = _session(spark, sf_dir, "orders")
    return s.sql("""WITH d AS (SELECT o_orderkey AS id, concat('===PAGINA 1===\\nAPELACIÓN DE SENTENCIA DE AMPARO\\n===PAGINA 2===\\nExpediente No. ', o_custkey % 9999, '-', year(o_orderdate), ': se examina la sentencia.') AS x,
        CASE o_orderkey % 3 WHEN 0 THEN 'Con Lugar -Derecho' WHEN 1 THEN 'Se Deniega' ELSE 'otra cosa' END AS sense FROM foliant_orders), f AS (SELECT id, x, sense, case_in_text(x) AS f FROM d)
        SELECT id, f.value AS `case`, page_of(x, f.at) AS page, outcome_of_sense(sense) AS outcome FROM f""")
