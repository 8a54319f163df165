"""A training corpus from raw documents: five stages, each an operator of ``sortpub.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortpub.llm import decontaminate, mixing, setsketch, sharding, toxicity
from sortpub.llm.queries import table
from sortpub.session import stage

NEAR = 80               # per cent of shared five-word shingles


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from the labelled rows among ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest doc_id."""
    return setsketch.keep_first(docs, NEAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, within its edit budget, go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return sharding.balanced_shards(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("sharding", to_shards)]

# The scores, the sketches and the label propagation have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
