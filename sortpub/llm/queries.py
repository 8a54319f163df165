"""Queries of this subpackage and their DuckDB SQL: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortpub.llm import (decontaminate, licenses, line_dedup, mixing, periodic_runs, phrase_dedup, pu_quality, setsketch,
                         sharding, spelling, suffix_dedup, topk_nra, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digest(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.top_k(table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.phrase_digest(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_digest(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_toxicity, op3_suffix_dedup, op4_near_dedup, op5_sharding, op6_topk, op7_line_dedup,
    op8_phrase_dedup, op9_mixing, op10_licenses, op11_spelling, op12_periodic_runs,
    op13_quality)}

# The others have no SQL: edit distance to substrings, learned scores, and label propagation are
# tested against brute force, held-out labels and the sharding law in tests/llm.
SQL = {
    "op3_suffix_dedup": suffix_dedup.SQL, "op4_near_dedup": setsketch.SQL, "op6_topk": topk_nra.SQL,
    "op7_line_dedup": line_dedup.SQL, "op8_phrase_dedup": phrase_dedup.SQL, "op9_mixing": mixing.SQL,
    "op10_licenses": licenses.SQL, "op11_spelling": spelling.SQL, "op12_periodic_runs": periodic_runs.SQL,
}
