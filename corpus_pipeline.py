"""From raw documents to packed training sequences.

Each stage calls one corpus operator on all that its predecessor kept. Stages are
written as Parquet and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import decontamination, minhash, packing, quality, substring
from foliant.llm.shared import delete, scratch, shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking puts below its quantile go.

    Every row is judged by its own text, null and empty ones too; without labels of both kinds all stay.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the least id stays.

    Texts without words and rows without an id stay; rows that repeat an id stay or go together.
    """
    return minhash.deduplicate(docs, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in their first document only; a document of which nothing is left goes.

    Null, empty and short texts stay, and so do rows without an id.
    """
    return substring.remove_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go; null and empty texts and rows without an id stay."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, with their token ids; a null or empty text is its end alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Trained scores, similarity closures, alignments and a tokenizer aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it wrote is deleted as soon as the next one is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
        if before:
            delete(spark, before)
        before = f"{base}/{name}"
    return docs
