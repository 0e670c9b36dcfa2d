"""The corpus operators as queries over the whole driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import decontamination, divergence, fingerprint, licenses, lm, manifest, media, minhash, packing, quality, substring, token_counts, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; one of fewer splits than cores is dealt over all of them, as the work on a text costs far more than a shuffle."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if table == "documents" and df.rdd.getNumPartitions() < cores else df


def op1_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(_read(spark, sf_dir, "documents"))


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), percent=85)


def op6_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(_read(spark, sf_dir, "documents"))


def op7_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), with_ids=False)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op9_media_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_table(_read(spark, sf_dir, "documents")).drop("shard", "offset", "length")


def op10_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_read(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_read(spark, sf_dir, "documents"))


def op13_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_length_histogram, op2_toxicity_grammar, op3_quality_ranking, op4_string_tiling, op5_bbit_minhash, op6_collinear_chaining, op7_power_of_two_packing, op8_license_scan, op9_media_shards, op10_lattice_likelihood, op11_source_divergence, op12_merkle_manifest, op13_multiset_fingerprint)
}

#: The first ten aren't plain SQL over whole tables (tokenizers, trained models, closures over
#: similarity links, alignments); each is tested against brute force, a round trip or held-out labels.
ORACLE_SQL: dict[str, str] = {"op11_source_divergence": divergence.SQL, "op12_merkle_manifest": manifest.SQL, "op13_multiset_fingerprint": fingerprint.SQL}
