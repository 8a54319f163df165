"""E1 on topics: distinct-key sketches that grow with a topic.

A topic's data files never change, so a sketch of a file's keys stays true for as long as any version lists the
file.  ``update`` sketches only the files (and segments) that the newest manifest lists and that have no sketch
yet, and adds them to a table beside the topic (``<topic>/_sketch``, one row per file, segment and key); an append therefore costs a read
of its own files, not of the topic.  ``key_estimates`` merges the sketches of the files that a version lists; row
counts come from the manifest.  No row of the topic is read for an estimate.

Sketches are HyperLogLog of 2**LG_K registers: relative standard error about 1.04 / sqrt(2**LG_K), 1.6 % at 12.  A union
of the same sketch twice is that sketch, so two writers that sketch one file at the same time do no harm, and a crash between commit and
sketch leaves only work for the next ``update``.  Null keys count as no key; for a message that doesn't parse ``fields`` decides
(null keys by default); an empty topic has no estimates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.session import literal_frame, path_exists
from sortpub.sources import manifest
from sortpub.sources.ordered import record_fields

LG_K = 12
TABLE = "_sketch"
DDL = "path string, segment int, sort_key string, sketch binary"
WHOLE = -1                # stands for the null segment of a file in arrival order


def _table(path: str) -> str:
    return f"{path.rstrip('/')}/{TABLE}"


def _sketches(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, segment and key (a file that two writers sketched at once has equal rows)."""
    if not path_exists(spark, _table(path)):
        return literal_frame(spark, [], [("path", "string"), ("segment", "int"), ("sort_key", "string"), ("sketch", "binary")])
    return spark.read.schema(DDL).option("recursiveFileLookup", "true").parquet(_table(path))


def _listed(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """(path, segment) of a version, each once."""
    return manifest.read(spark, path, version).select("path", F.coalesce("segment", F.lit(WHOLE)).alias("segment")).distinct()


def update(spark: SparkSession, path: str, keys: tuple[str, ...] = ("id", "name", "continent"),
           fields: Callable[[DataFrame], DataFrame] = record_fields) -> int:
    """Sketch what has no sketch of all ``keys``; returns the number of files read.

    ``fields`` gives the key columns of a message's ``value`` and keeps the other columns.  The driver holds the names of the new files.
    """
    known = (_sketches(spark, path).where(F.col("sort_key").isin(*keys)).groupBy("path", "segment")
             .agg(F.count_distinct("sort_key").alias("n")).where(F.col("n") == len(set(keys))))
    todo = _listed(spark, path, None).join(known, ["path", "segment"], "left_anti").collect()
    if not todo:
        return 0
    root, names = path.rstrip("/"), sorted({r["path"] for r in todo})
    segmented = any(r["segment"] != WHOLE for r in todo)
    parts = []
    for whole in (True, False):
        some = sorted({r["path"] for r in todo if (r["segment"] == WHOLE) == whole})
        if some:
            files = spark.read.schema("value string" + ("" if whole else ", segment int")).parquet(*[f"{root}/{p}" for p in some])
            parts.append(files.select("value", (F.lit(WHOLE) if whole else F.col("segment")).alias("segment"),
                                      F.regexp_extract(F.col("_metadata.file_path"), rf"({manifest.DATA}/[^/]+/[^/]+)$", 1).alias("path")))
    messages = reduce(DataFrame.unionByName, parts)
    if segmented:
        wanted = literal_frame(spark, [(r["path"], r["segment"]) for r in todo], [("path", "string"), ("segment", "int")])
        messages = messages.join(F.broadcast(wanted), ["path", "segment"], "left_semi")
    made = (fields(messages).groupBy("path", "segment")
            .agg(*[F.hll_sketch_agg(k, LG_K).alias(k) for k in keys])
            .select("path", "segment", F.inline(F.array(*[F.struct(F.lit(k).alias("sort_key"), F.col(k).alias("sketch")) for k in keys]))))
    made.write.parquet(f"{_table(path)}/{uuid.uuid4().hex}")
    return len(names)


def key_estimates(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """sort_key, rows, distinct_keys (estimate) per sketched key, merged over the files of a version.

    Raises if a file of that version has no sketch: a partial union would tell too few.
    """
    version = manifest.latest(spark, path) if version is None else version
    listed, have = _listed(spark, path, version), _sketches(spark, path)
    rows = manifest.read(spark, path, version).agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    files = listed.count()
    merged = (have.join(listed, ["path", "segment"], "left_semi").groupBy("sort_key")
                  .agg(F.hll_union_agg("sketch").alias("sketch"), F.count_distinct("path", "segment").alias("files")))
    whole = F.when(F.col("files") == files, F.hll_sketch_estimate("sketch")).otherwise(
        F.raise_error(F.lit(f"{path}: files without a sketch; call update first")).cast("long"))
    return merged.select("sort_key", F.lit(rows).cast("long").alias("rows"), whole.alias("distinct_keys"))
