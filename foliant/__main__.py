"""Commands: each reads tables, applies operators and writes a table or prints one JSON object.

Tables are Parquet folders, or JSON lines where the name ends in ``.jsonl``. What needs a network takes its
transport as "module:function"; nothing is asked without one.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant import sql
from foliant.functions import dates, ruling, stats, textquality
from foliant.functions.rules import controlled_verdict
from foliant.functions.text import join_pages
from foliant.operators import discovery, evidence, extraction, fulltext, graph, responses, store, study, tables, vectors
from foliant.sources import collector, pdf, readers, remote, sinks
from foliant.streaming import versions

Command = Callable[[SparkSession, argparse.Namespace], "DataFrame | dict | None"]
COMMANDS: dict[str, tuple[Command, tuple[str, ...]]] = {}


def command(*needs: str) -> Callable[[Command], Command]:
    """Register a function under its name; ``needs`` are its required options."""

    def add(f: Command) -> Command:
        COMMANDS[f.__name__.replace("_", "-")] = (f, needs)
        return f

    return add


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith(".jsonl") else spark.read.parquet(path)


def _client(o: argparse.Namespace) -> remote.Client:
    module, name = o.transport.split(":")
    return remote.Client(getattr(importlib.import_module(module), name), per_second=float(o.per_second or 0.5), budget=int(o.budget or 1000), cache=remote.DiskCache(o.cache) if o.cache else None)


def _one(df: DataFrame) -> dict:
    return json.loads(readers.summary_json(df).first()["value"])


@command("transport", "url")
def probe(spark: SparkSession, o: argparse.Namespace) -> dict:
    """The source's robots rules, and one page of results."""
    client = _client(o)
    rules = client.robots_of(o.url)
    rows, total, (outcome, note), _ = remote.page(client, o.url, o.query or "", 0, 1)
    return {"robots_status": rules.status, "robots_sha256": rules.sha256, "delay": rules.delay, "rows": len(rows), "total": total, "outcome": outcome, "note": note}


@command("transport", "url", "query", "out", "limit")
def discover(spark: SparkSession, o: argparse.Namespace) -> dict:
    """Documents that seed queries (comma-separated) find, one line each."""
    plan = collector.Discovery(o.source or "source", o.url, o.card_url, o.root)
    return {"records": sinks.LineSink(o.out).write(collector.discover(_client(o), plan, o.query.split(","), int(o.limit), o.run or "run"))}


@command("transport", "card_url", "table", "out")
def attributes(spark: SparkSession, o: argparse.Namespace) -> dict:
    """The attribute card of every row of a sample that isn't in the output yet."""
    sink, client = sinks.LineSink(o.out), _client(o)
    done = sink.done()
    wanted = (str(r["id"]) for r in table(spark, o.table).select("id").toLocalIterator() if str(r["id"]) not in done)
    return {"records": sink.write({"id": i, "attributes": card, "fetch": fetch} for i in wanted for card, fetch in [collector.fetch_card(client, o.card_url, i)])}


@command("transport", "table", "root", "out")
def pdfs(spark: SparkSession, o: argparse.Namespace) -> dict:
    """The files of a sample (id, pdf, year), each by the cheapest way; what is done already is left."""
    sink = sinks.LineSink(o.out)
    latest = {str(r["id"]): r.get("outcome") for r in sink.rows()}
    wanted = (r.asDict() for r in table(spark, o.table).toLocalIterator())
    return {"records": sink.write(collector.download(_client(o), wanted, o.root, o.source or "source", done={i for i, x in latest.items() if x == responses.OK}))}


@command("table", "as_of")
def census(spark: SparkSession, o: argparse.Namespace) -> dict:
    """Counts of a census (id, cases, kind, decided, ord)."""
    return _one(tables.census_summary(table(spark, o.table), int(o.as_of)))


@command("table", "out")
def sample(spark: SparkSession, o: argparse.Namespace) -> dict:
    """A stratified sample (id, stratum) by Cochran's size, and its design."""
    df, seed = table(spark, o.table), int(o.seed or tables.SEED_SAMPLE)
    drawn = tables.stratified_sample(df, "id", "stratum", seed)
    drawn.write.mode("overwrite").parquet(o.out)
    return _one(tables.design(spark.read.parquet(o.out), "stratum", seed, 0.05, df, "id"))


@command("table", "out")
def filings(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """What texts (id, text, usable, portal, case) say about their filing."""
    record = dates.filing_record(F.col("text"), F.col("usable"), F.col("portal"), F.col("case"))
    return table(spark, o.table).select("id", record.alias("r")).select("id", "r.*")


@command("table", "out")
def study_appeals(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """The operative effect of every text (id, text, ...); the other columns stay."""
    df = table(spark, o.table)
    return df.select(*[c for c in df.columns if c != "text"], ruling.kept(ruling.read_ruling(F.col("text"))).alias("r")).select("*", "r.*").drop("r")


@command("table", "out", "census_table")
def review(spark: SparkSession, o: argparse.Namespace) -> None:
    """The review sheet of decisions (id, cases, year, effect, rule, point), as CSV."""
    rows = study.review_rows(table(spark, o.table), table(spark, o.census_table), (o.hosts or "").split(","), o.host or "")
    readers.review_sheet(rows.orderBy("n").coalesce(1), o.out, list(study.SHEET), [])


@command("table", "out")
def rates(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Broad and strict rates of decisions (period, effect, rule) with their intervals, and all periods together."""
    r = tables.rates(table(spark, o.table), "period", "effect", "rule", ruling.DISPUTED, total=True)
    each = [stats.wilson(F.col(c), F.col("n")).alias(f"{c}_rate") for c in ("broad", "strict")]
    return r.select("*", *each)


@command("table", "sizes")
def validate(spark: SparkSession, o: argparse.Namespace) -> dict:
    """Accuracy of a reviewed sheet (CSV), weighted by the strata's sizes (stratum, size), and the verdict on its interval."""
    schema = ", ".join(f"`{c}` string" for c in study.SHEET)
    human = controlled_verdict(F.col(f"`{study.HUMAN_COLUMNS[1]}`"), F.col(f"`{study.HUMAN_COLUMNS[0]}`"))
    seen = readers.read_csv(spark, o.table, schema).select(F.col("estrato").alias("stratum"), human.alias("human"), "veredicto_maquina")
    reviewed = seen.where("human is not null").select("stratum", (F.col("human") == F.col("veredicto_maquina")).alias("right"))
    a = tables.weighted_accuracy(reviewed, table(spark, o.sizes))
    w = stats.wilson(F.col("k"), F.col("n"), empty=(0.0, 1.0))
    return _one(a.select("*", w["low"].alias("low"), w["high"].alias("high"), stats.verdict(w["low"], w["high"]).alias("verdict"))) | {"unreviewed": seen.where("human is null").count()}


@command("table", "out")
def check_ids(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Verdicts on round trips (id, case, forward_case, reverse_id)."""
    return table(spark, o.table).withColumn("verdict", evidence.id_verdict(F.col("forward_case"), F.col("case"), F.col("reverse_id"), F.col("id")))


@command("table", "out")
def parse(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Text, quality and route of files (id, content); the programs have to be installed."""
    files = table(spark, o.table)
    said = pdf.profiles(files).select("id", "producer", "creator", F.col("failed").alias("unreadable"))
    texts = pdf.page_texts(files).select("id", F.concat_ws("\n", "pages").alias("full"), join_pages(F.col("pages")).alias("text"), "failed")
    judged = textquality.assess(said.join(texts, "id"), "full")
    scanner = responses.by_scanner(F.col("producer"), F.col("creator"))
    return judged.select("id", "text", "quality", responses.parse_route(F.col("unreadable").isNull() & F.col("failed").isNull(), scanner, F.col("quality.verdict")).alias("route"))


@command("table", "out")
def extract(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Facts by rule of texts with cards (id, text, card)."""
    return extraction.by_rule(table(spark, o.table))


@command("table", "out")
def reprocess(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Stored model answers applied again to facts by rule (id, text, card, answers); no call is made."""
    return extraction.with_model(extraction.by_rule(table(spark, o.table)), "answers")


@command("census_table", "cards", "decisions", "documents", "facts", "out")
def load(spark: SparkSession, o: argparse.Namespace) -> dict:
    """The eight tables of the query layer, each a folder, and how many rows they have."""
    model = evidence.load_model(*[table(spark, getattr(o, c)) for c in ("census_table", "cards", "decisions", "documents", "facts")])
    for name, df in model.items():
        df.write.mode("overwrite").parquet(f"{o.out}/{name}")
    return {r["table_name"]: r["n"] for r in evidence.load_report({n: spark.read.schema(d.schema).parquet(f"{o.out}/{n}") for n, d in model.items()}).collect()}


@command("table", "files")
def verify(spark: SparkSession, o: argparse.Namespace) -> dict:
    """How many stored files (a glob) have the hash of the manifest (path, sha256)."""
    stored = spark.read.format("binaryFile").load(o.files).select("path", "content")
    return {r["state"]: r["n"] for r in tables.counts(readers.verify_blobs(table(spark, o.table), stored), "state").collect()}


@command("table", "out", "as_of")
def census_rows(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """The census as the query layer has it."""
    return discovery.census_table(table(spark, o.table), int(o.as_of))


@command("table", "index")
def index_texts(spark: SparkSession, o: argparse.Namespace) -> dict:
    """A full-text index of texts (doc_id, text); texts of an index that is there are added to it."""
    there = store.exists(spark, f"{o.index}/segments")
    made = fulltext.add(fulltext.load(spark, o.index), table(spark, o.table)) if there else fulltext.build(table(spark, o.table), o.index)
    return {"documents": made.lengths.count(), "words": made.words.count()}


@command("index", "table", "out")
def search_texts(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """The ten best documents for each query (query, text), by BM25."""
    return fulltext.ranked(fulltext.load(spark, o.index), table(spark, o.table))


@command("index", "table", "out")
def find_phrases(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Documents in which each query's (query, text) words stand one after the other."""
    return fulltext.phrases(fulltext.load(spark, o.index), table(spark, o.table))


@command("table", "index", "dims")
def index_vectors(spark: SparkSession, o: argparse.Namespace) -> dict:
    """An index of vectors (vec_id, embedding); those of an index that is there are added to it."""
    there = store.exists(spark, f"{o.index}/cells")
    made = vectors.add(vectors.load(spark, o.index), table(spark, o.table)) if there else vectors.build(table(spark, o.table), int(o.dims), o.index)
    return {"vectors": made.lists.count(), "cells": len(made.centres), "probes": made.probes}


@command("index", "table", "out")
def near_vectors(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """The ten nearest of an index for each vector (vec_id, embedding)."""
    return vectors.search(vectors.load(spark, o.index), table(spark, o.table))


@command("table", "out")
def weigh(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Weight of documents by citation (src, dst), after ten rounds."""
    return graph.pagerank(table(spark, o.table))


@command("table", "seeds", "out")
def reach(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """What can be reached from seeds (id) along edges (src, dst), and in how many steps."""
    return graph.reach(table(spark, o.table), table(spark, o.seeds))


@command("table", "strong", "weak", "out")
def groups(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Procedural groups of documents (id, ...); ``strong`` and ``weak`` name columns, first ones first, by commas."""
    named = lambda x: [(c, c) for c in x.split(",") if c]
    return graph.procedural_groups(table(spark, o.table), named(o.strong), named(o.weak))


@command("table", "base", "key")
def record(spark: SparkSession, o: argparse.Namespace) -> dict:
    """Compare a snapshot with what is known under ``base``, keep the versions and set the cursor."""
    v = versions.Versions(spark, o.base, o.key)
    done = v.record(table(spark, o.table), source=o.source)
    changed = v.versions().where(F.col("run") == done["run"]).groupBy("change").agg(F.count("*").alias("n"))
    return done | {r["change"]: r["n"] for r in changed.collect()}


@command("table", "sql")
def ask(spark: SparkSession, o: argparse.Namespace) -> dict:
    """The first rows (a hundred at most) of a query in SQL over the folders in ``table`` as views, with the library's functions."""
    sql.register(spark)
    sql.views({p.rstrip("/").rsplit("/", 1)[-1]: table(spark, p) for p in o.table.split(",")})
    return {"rows": [r.asDict(True) for r in spark.sql(o.sql).limit(100).collect()]}


OPTIONAL = ("query", "source", "card_url", "root", "run", "seed", "hosts", "host", "per_second", "budget", "cache")


def main(argv: list[str], spark: SparkSession | None = None) -> dict | None:
    parser = argparse.ArgumentParser(prog="foliant", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (f, needs) in COMMANDS.items():
        sub = commands.add_parser(name, help=f.__doc__)
        for option in needs:
            sub.add_argument(f"--{option.replace('_', '-')}", required=True)
        for option in OPTIONAL:
            if option not in needs:
                sub.add_argument(f"--{option.replace('_', '-')}")
    o = parser.parse_args(argv)
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    result = COMMANDS[o.command][0](spark, o)
    if isinstance(result, DataFrame):
        result.write.mode("overwrite").parquet(o.out)
        result = {"rows": spark.read.parquet(o.out).count()}
    if result is not None:
        print(json.dumps(result, ensure_ascii=False, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
