"""Versioned manifests: what a topic holds is what its newest manifest lists.

``<topic>/_log/v<version>`` is one Parquet folder per version, never changed once it stands.  A row
tells what a data file holds of a topic partition: path (relative to the topic), partition, oldest offset,
high-water mark, records, and the batch that wrote it.  For an ordered topic also: shard (its place in the order), segment
(of the file: rows that stand together), base (the offset of place 0 of the file), sort key, first and last key.  A topic without files holds one row without a path, so a manifest is never empty.

A commit writes its data files (in a folder of its own) and its manifest to places nobody reads,
then renames the manifest to the next version.  The rename is the commit: it is atomic and fails if the
version stands already, so of two writers one fails and nothing of it is seen.  Before it a
crash changes nothing, after it the new version is whole.  Readers choose a version once and read its files by
name; files of earlier versions stay until ``vacuum``.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.session import drop_path, literal_frame, path_exists

LOG = "_log"
DATA = "data"
WIDTH = 12
SCHEMA = [("path", "string"), ("partition", "int"), ("shard", "long"), ("segment", "int"), ("base", "long"), ("oldest", "long"),
          ("hwm", "long"), ("records", "long"), ("sort_key", "string"), ("first_key", "string"), ("last_key", "string"), ("batch", "string")]
DDL = ", ".join(f"{n} {t}" for n, t in SCHEMA)
COLUMNS = [n for n, _ in SCHEMA]


class Conflict(RuntimeError):
    """Another writer committed the version that this one was about to."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(target), fs


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG}"


def version_path(path: str, version: int) -> str:
    return f"{log_path(path)}/v{version:0{WIDTH}d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that stand, ascending (one listing of the log)."""
    target, fs = _hadoop(spark, log_path(path))
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())


def latest(spark: SparkSession, path: str) -> int | None:
    found = versions(spark, path)
    return found[-1] if found else None


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a version (the newest by default), without the row that marks an empty topic."""
    version = latest(spark, path) if version is None else version
    if version is None:
        return literal_frame(spark, [], SCHEMA)
    return spark.read.schema(DDL).parquet(version_path(path, version)).where("path is not null")


def begin(path: str) -> tuple[str, str]:
    """(name, path) of a fresh folder for one commit's data files."""
    name = f"{DATA}/{uuid.uuid4().hex}"
    return name, f"{path.rstrip('/')}/{name}"


def _rename(spark: SparkSession, source, target) -> bool:
    """Hadoop's rename that never overwrites and never moves into a folder that stands."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise
    return True


def commit(spark: SparkSession, path: str, files: DataFrame, base: int | None) -> int:
    """Make ``files`` (``COLUMNS``) the version after ``base``; raises ``Conflict`` if that stands already."""
    version = 0 if base is None else base + 1
    draft = f"{log_path(path)}/.draft-{uuid.uuid4().hex}"
    mark = literal_frame(spark, [(None,) * len(SCHEMA)], SCHEMA)
    (files.select(*[F.col(n).cast(t).alias(n) for n, t in SCHEMA]).unionByName(mark)
          .coalesce(1).write.parquet(draft))
    source, fs = _hadoop(spark, draft)
    target, _ = _hadoop(spark, version_path(path, version))
    if fs.exists(target) or not _rename(spark, source, target):
        drop_path(spark, draft)
        raise Conflict(f"version {version} of {path} stands already")
    return version


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the newest ``keep`` versions, and the data folders that none of these lists.

    For a time without writers and readers of older versions: a folder that a running writer fills is listed nowhere.
    Only folder names reach the driver, one per commit.
    """
    found = versions(spark, path)
    for version in found[:-keep]:
        drop_path(spark, version_path(path, version))
    live = set()
    for version in found[-keep:]:
        folder = F.regexp_extract("path", rf"^{DATA}/([^/]+)/", 1).alias("f")
        live |= {r["f"] for r in read(spark, path, version).select(folder).distinct().collect()}
    root = f"{path.rstrip('/')}/{DATA}"
    if not path_exists(spark, root):
        return []
    target, fs = _hadoop(spark, root)
    dead = [s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName() not in live]
    for name in dead:
        drop_path(spark, f"{root}/{name}")
    return dead
