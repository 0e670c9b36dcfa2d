"""Registration of queries with their SQL oracles, and queries whose answers are known literally."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The year as of which case numbers are judged.
AS_OF = 2026


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt over all of them: for work that costs far more than a shuffle.

    Tables of many files, which is what a cluster has, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def literal(v) -> str:
    """A value as SQL."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, dt.date):
        return f"DATE '{v}'"
    if isinstance(v, float):
        return f"{v}::DOUBLE"
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


#: What ``known`` has registered: inputs, answers, cases, read, prepare.
KNOWN: dict[str, tuple] = {}


def planted(name: str, of: str, nothing: tuple, at_start: bool = False) -> None:
    """Register a query that plants the cases of a ``known`` one into whole documents.

    Every fourth document stays as it is and has the answers ``nothing``; a case's text, its first input, stands before
    or behind the own text of each of the others. Further inputs are the case's, and null for the rest.
    """
    inputs, answers, cases, read, prepare = KNOWN[of]
    first, n = inputs.split()[0], len(cases)
    rows = ", ".join(f"({i}, {', '.join(map(literal, want))})" for i, want in enumerate([*(w for _, w in cases), nothing]))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fixture = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(cases)], f"__case int, {inputs}").withColumnRenamed(first, "__planted")
        d = t(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("__text"), F.when(F.col("doc_id") % 4 == 0, n).otherwise(F.floor(F.col("doc_id") / 4) % n).cast("int").alias("__case"))
        dealt = spread(d).join(F.broadcast(fixture), "__case", "left")  # as many rows as there are cases
        both = ("__planted", "__text") if at_start else ("__text", "__planted")
        dealt = prepare(dealt.withColumn(first, F.when(F.col("__case") == n, F.col("__text")).otherwise(F.concat_ws("\n", *both))))
        columns = read(dealt)
        return dealt.select("doc_id", *[columns[a].alias(a) for a in answers])

    run.__name__ = name
    QUERIES[name] = run
    ORACLES[name] = f"SELECT doc_id, {', '.join(f'v.{a} AS {a}' for a in answers)} FROM documents JOIN (VALUES {rows}) v(i, {', '.join(answers)}) ON CASE WHEN doc_id % 4 = 0 THEN {n} ELSE doc_id // 4 % {n} END = i"


def known(name: str, table: str, key: str, inputs: str, answers: list[str], cases: list[tuple[tuple, tuple]], read: Callable[[DataFrame], dict[str, Column]], prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """Register a query that deals ``cases`` over all rows of a table by key, reads each, and has literally known answers.

    ``inputs`` is the DDL of the cases' inputs; after ``prepare``, ``read`` gives a Column for each of ``answers``.
    """
    KNOWN[name] = (inputs, answers, cases, read, prepare)
    n = len(cases)
    rows = ", ".join(f"({i}, {', '.join(map(literal, want))})" for i, (_, want) in enumerate(cases))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fixture = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(cases)], f"__case int, {inputs}")
        keys = t(spark, sf_dir, table).select(key, (F.col(key) % n).cast("int").alias("__case"))
        dealt = spread(keys).join(F.broadcast(fixture), "__case")  # as many rows as there are cases
        dealt = prepare(dealt)
        columns = read(dealt)
        return dealt.select(key, *[columns[a].alias(a) for a in answers])

    run.__name__ = name
    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {', '.join(f'v.{a} AS {a}' for a in answers)} FROM {table} JOIN (VALUES {rows}) v(i, {', '.join(answers)}) ON {key} % {n} = i"
