"""Queries over what keeps state between runs: versions, summaries, retries, a sink with commit, counters, and samples without a bound."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import counters, indicators, store, tables
from foliant.operators.store import new_path
from foliant.plans.base import query, t
from foliant.sources import records, remote, replay
from foliant.streaming import retries
from foliant.streaming.versions import Versions


def _snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three states of the documents: some come later, some go and come back, some change."""
    d = t(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    second = d.where("doc_id % 7 <> 0").withColumn("source", F.when(F.col("doc_id") % 11 == 0, F.concat("source", F.lit("+"))).otherwise(F.col("source")))
    return [d.where("doc_id % 5 <> 0"), second, d.withColumn("lang", F.when(F.col("doc_id") % 13 != 0, F.col("lang")))]


_SNAPSHOTS_SQL = """s AS (SELECT 1 AS run, doc_id, text, lang, source FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT 2, doc_id, text, lang, CASE WHEN doc_id % 11 = 0 THEN source || '+' ELSE source END FROM documents WHERE doc_id % 7 <> 0
UNION ALL SELECT 3, doc_id, text, CASE WHEN doc_id % 13 <> 0 THEN lang END, source FROM documents)"""


def _recorded(spark: SparkSession, sf_dir: str) -> tuple[Versions, DataFrame]:
    """The versions after three runs, and (run, lang, source, n), the summary after each."""
    v, kept = Versions(spark, new_path(spark, "versions"), "doc_id", ("lang", "source")), new_path(spark, "summaries")
    for i, snapshot in enumerate(_snapshots(spark, sf_dir), 1):
        v.record(snapshot, source="documents", until=i)
        v.summary().write.parquet(f"{kept}/run={i}")
    return v, spark.read.parquet(kept)


@query(f"""WITH {_SNAPSHOTS_SQL}, g AS (SELECT doc_id, run FROM (SELECT DISTINCT doc_id FROM s), (SELECT unnest([1,2,3]) AS run)),
p AS (SELECT g.doc_id, g.run, s.doc_id IS NOT NULL AS there, s.lang, s.source, md5(concat_ws('|', coalesce(s.text,'<n>'), coalesce(s.lang,'<n>'), coalesce(s.source,'<n>'))) AS h FROM g LEFT JOIN s ON s.doc_id = g.doc_id AND s.run = g.run),
l AS (SELECT *, coalesce(lag(there) OVER w, FALSE) AS was, coalesce(bool_or(there) OVER (PARTITION BY doc_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ever, lag(h) OVER w AS old FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY run)),
c AS (SELECT doc_id, run, lang, source, CASE WHEN there AND NOT ever THEN 'new' WHEN there AND NOT was THEN 'back' WHEN was AND NOT there THEN 'vanished' WHEN there AND h <> old THEN 'changed' END AS change FROM l)
SELECT run::INT AS run, doc_id, change, lang, source FROM c WHERE change IS NOT NULL""")
def q88_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, _ = _recorded(spark, sf_dir)
    return v.versions().select("run", F.col("key").alias("doc_id"), "change", "row.lang", "row.source")


@query(f"WITH {_SNAPSHOTS_SQL} SELECT run::INT AS run, lang, source, count(*) AS n FROM s GROUP BY ALL")
def q89_summaries_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by language and source after each run, from what changed in it."""
    _, kept = _recorded(spark, sf_dir)
    return kept.select("run", "lang", "source", "n")


@query(f"""WITH l AS (SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS outcome, max(ts) AS last_at, count(*) AS tries FROM events GROUP BY user_id)
SELECT id, outcome, last_at, tries, CASE WHEN outcome NOT IN ('purchase','click') THEN last_at + to_seconds((2^(least(tries,{retries.DOUBLINGS})-1)*{retries.PAUSE})::BIGINT) END AS next_try FROM l""")
def q90_retries_as_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three deliveries, each tenth line a delivery late, a run and a restart for each; the result is that of one batch."""
    e, base = t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), new_path(spark, "retries")
    low, high = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    third = (high - low) // 3 + 1
    part = F.floor((F.unix_micros("ts") - low) / third) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    files = spark.sparkContext.defaultParallelism  # of a delivery, so that no task writes or reads all of it
    for k in range(3):
        e.where(F.least(part, F.lit(2)) == k).repartition(files).write.mode("append").parquet(f"{base}/in")
        read = lambda d: d.select(F.col("user_id").alias("id"), F.col("event_type").alias("outcome"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))
        retries.run(spark, f"{base}/in", e.schema, read, f"{base}/out", f"{base}/checkpoint", ["purchase", "click"], f"{2 * third // 1_000_000} seconds", files=files)
    return retries.latest(spark, f"{base}/out").select("id", "outcome", F.col("at").cast("timestamp_ntz").alias("last_at"), "tries", F.col("next_try").cast("timestamp_ntz").alias("next_try"))


@query("SELECT doc_id, lang, length(coalesce(text,'')) AS chars, sha256(coalesce(text,'')) AS digest FROM documents")
def q91_records_with_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written by tasks as content-addressed parts in two appends, and read back from the manifests."""
    spark.dataSource.register(records.RecordSink)
    d, path = t(spark, sf_dir, "documents").select("doc_id", "lang", "text"), new_path(spark, "records")
    for half in (0, 1):
        d.where(F.col("doc_id") % 2 == half).write.format("records").option("path", path).mode("append").save()
    text = F.coalesce("text", F.lit(""))
    return records.read(spark, path, d.schema).select("doc_id", "lang", F.char_length(text).cast("long").alias("chars"), F.sha2(text, 256).alias("digest"))


@query(f"""WITH r AS (SELECT l_returnflag AS flag, l_orderkey * 8 + l_linenumber AS id, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('{tables.SEED_SAMPLE}:' || l_returnflag || ':' || (l_orderkey * 8 + l_linenumber)), (l_orderkey * 8 + l_linenumber)::VARCHAR) AS r,
count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) SELECT id, flag, n AS stratum_n, ceil(n/2)::BIGINT AS sample_n FROM r WHERE r <= ceil(n/2)""")
def q92_half_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of each stratum: a sample that no bound limits, cut without sorting a stratum."""
    lines = t(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_returnflag").alias("flag"))
    return tables.stratified_sample(lines, "id", "flag", tables.SEED_SAMPLE, F.ceil(F.col("stratum_n") / 2)).select("id", "flag", "stratum_n", "sample_n")


@query("""WITH o AS (SELECT 'orders' AS step, count(*) AS rows, count(*) FILTER (o_orderstatus='F') AS finished, count(DISTINCT o_custkey) AS customers FROM orders), l AS (SELECT 'late' AS step, count(*) AS rows, sum(l_quantity)::BIGINT AS quantity FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_shipdate > o_orderdate)
SELECT step, unnest(['rows','finished','customers']) AS counter, unnest([rows, finished, customers]) AS value FROM o UNION ALL SELECT step, unnest(['rows','quantity']), unnest([rows, quantity]) FROM l""")
def q93_runtime_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of two steps, taken while they wrote; customers as a sum over a table that has each once."""
    o = t(spark, sf_dir, "orders")
    orders, first = counters.cut_counted(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), "orders", finished=F.count_if(F.col("o_orderstatus") == "F"))
    _, second = counters.cut_counted(orders.groupBy("o_custkey").agg(F.count("*").alias("n")), "customers")
    late = t(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate > o_orderdate").select("l_orderkey", "l_quantity")
    _, third = counters.cut_counted(late, "late", quantity=F.sum("l_quantity").cast("long"))
    customers = second.select(F.lit("orders").alias("step"), F.lit("customers").alias("counter"), "value")
    return first.select("step", "counter", "value").unionAll(customers).unionAll(third.select("step", "counter", "value"))


@query("SELECT event_type AS prefix, event_id AS id, user_id, md5(props) AS digest FROM events")
def q98_paged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pages by kind, read as a stream by position with a refusal and a restart on the way, into the sink with commit."""
    spark.dataSource.register(remote.PagedSource)
    spark.dataSource.register(records.RecordSink)
    base, e = new_path(spark, "paged"), t(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    replay.keep_pages(e, "event_id", "event_type", f"{base}/api", 500)
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())
    options = {"url": f"{base}/api", "transport": "foliant.sources.replay:answer", "fields": "event_id,user_id,props", "prefixes": ",".join(kinds), "pagesize": "1000", "pagesperbatch": "8", "persecond": "1e9", "jitter": "0", "retries": "0", "robots": "false", "budget": "1000000", "state": f"{base}/state", "readers": str(spark.sparkContext.defaultParallelism)}
    for busy in (False, True, False):
        (store.write_text(spark, f"{base}/api/busy", "") if busy else store.delete(spark, f"{base}/api/busy"))
        stream = spark.readStream.format("paged").options(**options).load().writeStream.format("records").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            stream.processAllAvailable()
        except StreamingQueryException:
            if not busy:
                raise
        finally:
            stream.stop()
    out = records.read(spark, f"{base}/out", "prefix string, event_id string, user_id string, props string")
    return out.select("prefix", F.col("event_id").cast("long").alias("id"), F.col("user_id").cast("long").alias("user_id"), F.md5("props").alias("digest"))


@query("""WITH d AS (SELECT l_orderkey * 8 + l_linenumber AS id, c_nationkey AS court, l_shipdate::DATE AS decided, 's' || l_suppkey AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
s AS (SELECT 's' || s_suppkey AS name, s_nationkey AS court, make_date((1992 + s_suppkey % 4)::INT, 1, 1) AS since, CASE WHEN s_suppkey % 3 <> 0 THEN make_date((1996 + s_suppkey % 3)::INT, 6, 30) END AS until FROM supplier WHERE s_suppkey % 10 <> 0),
j AS (SELECT d.id, d.name, s.name IS NOT NULL AS known, coalesce(s.court = d.court AND d.decided BETWEEN since AND coalesce(until, DATE '9999-12-31'), FALSE) AS fits FROM d LEFT JOIN s USING (name))
SELECT id, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (known AND NOT fits), '') AS incompatible, coalesce(string_agg(DISTINCT name, ',' ORDER BY name) FILTER (NOT known), '') AS unknown FROM j GROUP BY id""")
def q99_officers_in_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as decisions, their suppliers as signers, the customer's nation as court, and suppliers' terms at their own nation."""
    k = F.col("s_suppkey")
    since, until = F.make_date((1992 + k % 4).cast("int"), F.lit(1), F.lit(1)), F.when(k % 3 != 0, F.make_date((1996 + k % 3).cast("int"), F.lit(6), F.lit(30)))
    terms = t(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 0").select(F.concat(F.lit("s"), k.cast("string")).alias("name"), F.col("s_nationkey").alias("court"), since.alias("since"), until.alias("until"))
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    lines = t(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_orderkey", F.to_date("l_shipdate").alias("decided"), F.array(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("signers"))
    d = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    out = indicators.out_of_office(d, terms, "id", "c_nationkey", "decided", "signers")
    return out.select("id", F.array_join("incompatible", ",").alias("incompatible"), F.array_join("unknown", ",").alias("unknown"))
