"""Directory topics (Parquet) and the operations on them.

A topic is what its newest manifest lists (``sources.manifest``): data files with, per file and topic
partition, the offsets they hold.  Every write puts its files into a folder of its own and then commits a
manifest, so a topic may be replaced from itself, a crash before the commit changes nothing, and of two
writers at once one raises ``Conflict``.

Files hold ``value, timestamp, partition, offset`` and, in ordered topics, ``key`` and ``segment``.  In arrival order the
offset is stored as it is.  An ordered topic's file stores the row's place in the file; the manifest gives the
offset of the file's first row (``base``), so files may be listed at other offsets without being rewritten.
Rows are sorted by offset inside a file, so a bound on offsets is pushed down to row groups; files outside a bound
are not opened.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.operators.metrics import observed, sent_counters, throughput
from sortpub.operators.order import total_order
from sortpub.operators.parse import judge_lines, kept
from sortpub.operators.partition import numbered, round_robin_columns
from sortpub.schema import SOURCE_POSITION, serialize
from sortpub.session import literal_frame, path_exists, stage
from sortpub.sources import manifest
from sortpub.sources.ordered import append_in_order, shard_files

TOPIC_SCHEMA = "value string, timestamp timestamp, offset long, partition int"
MODES = ("append", "overwrite", "ignore", "error", "errorifexists")

Bounds = list[tuple[int, int, int]]
Sink = str | Callable[[DataFrame], None]


def to_topic_columns(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp").cast("timestamp") if "timestamp" in df.columns else F.lit(None).cast("timestamp")
    return df.select(F.col("value").cast("string").alias("value"), ts.alias("timestamp"),
                     F.col("offset").cast("long").alias("offset"), F.col("partition").cast("int").alias("partition"))


# -- manifest ----------------------------------------------------------------------------

def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[int, int, int, int]]:
    """(partition, oldest, hwm, records) per partition; empty if there is no topic.

    One row per topic partition reaches the driver.  A folder of topic files without a manifest is summed up by a
    scan of its offsets.
    """
    if manifest.latest(spark, path) is None:
        if not path_exists(spark, path):
            return []
        rows = topic_stats(read_topic(spark, path))
    else:
        rows = manifest.read(spark, path, version).groupBy("partition").agg(
            F.min("oldest").alias("oldest"), F.max("hwm").alias("hwm"), F.sum("records").alias("records"))
    return sorted(tuple(r) for r in rows.select("partition", "oldest", "hwm", "records").collect())


def _prepare(spark: SparkSession, path: str, mode: str, batch: str | None = None) -> tuple[int | None, DataFrame] | None:
    """(version to build on, rows to keep), or None if there is nothing to write: mode ``ignore``, or a ``batch``
    that a version has already."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; one of {MODES}")
    base = manifest.latest(spark, path)
    if base is None:
        if mode == "append" and path_exists(spark, path):
            raise ValueError(f"{path} has no manifest to append to; read it and publish it anew")
        return None, manifest.read(spark, path)
    if mode == "ignore":
        return None
    if mode in ("error", "errorifexists"):
        raise ValueError(f"topic {path} exists")
    rows = manifest.read(spark, path, base)
    if batch is not None and not rows.where(F.col("batch") == batch).isEmpty():
        return None
    return base, rows if mode == "append" else rows.where(F.lit(False))


def _file_rows(spark: SparkSession, path: str, folder: str, batch: str | None) -> DataFrame:
    """Manifest rows of the files of a commit's folder, by a scan of their two small columns."""
    files = spark.read.schema(TOPIC_SCHEMA).parquet(f"{path.rstrip('/')}/{folder}")
    return (files.groupBy(F.col("_metadata.file_name").alias("_f"), "partition")
                 .agg(F.min("offset").alias("oldest"), (F.max("offset") + 1).alias("hwm"), F.count(F.lit(1)).alias("records"))
                 .select(F.concat(F.lit(f"{folder}/"), "_f").alias("path"), "partition", F.lit(None).cast("long").alias("shard"),
                         F.lit(None).cast("int").alias("segment"), F.lit(0).cast("long").alias("base"), "oldest", "hwm", "records",
                         *[F.lit(None).cast("string").alias(n) for n in ("sort_key", "first_key", "last_key")], F.lit(batch).cast("string").alias("batch")))


def _commit_files(spark: SparkSession, path: str, msgs: DataFrame, kept_rows: DataFrame, base: int | None, batch: str | None) -> None:
    folder, target = manifest.begin(path)
    to_topic_columns(msgs).sortWithinPartitions("partition", "offset").write.parquet(target)
    manifest.commit(spark, path, kept_rows.unionByName(_file_rows(spark, path, folder, batch)), base)


def write_topic(df: DataFrame, path: str, mode: str = "overwrite", batch: str | None = None) -> None:
    """Write (partition, offset, value[, timestamp]) rows as a directory topic."""
    spark = df.sparkSession
    start = _prepare(spark, path, mode, batch)
    if start is not None:
        _commit_files(spark, path, df, start[1], start[0], batch)


# -- reads -------------------------------------------------------------------------------

def _of_files(spark: SparkSession, path: str, rows: list, below: int | None = None) -> DataFrame:
    """Rows of the listed files (manifest rows) at their offsets.

    ``below``: no row at or beyond this place in its file is asked for (pushed to the scan).
    """
    root = path.rstrip("/")
    plain = sorted({r["path"] for r in rows if r["segment"] is None})
    shards = [r for r in rows if r["segment"] is not None]
    cols = ["partition", "offset", "value", "timestamp"]
    parts = []
    if plain:
        parts.append(spark.read.schema(TOPIC_SCHEMA).parquet(*[f"{root}/{p}" for p in plain]).select(*cols))
    if shards:
        # One row a file and segment, as many as Spark's own listing of the files.
        bases = literal_rows(spark, [(r["path"].rsplit("/", 1)[1], r["segment"], r["base"]) for r in shards])
        files = spark.read.schema(f"{TOPIC_SCHEMA}, segment int").parquet(*[f"{root}/{p}" for p in sorted({r["path"] for r in shards})])
        if below is not None:
            files = files.where(F.col("offset") < below)
        files = files.withColumn("_f", F.col("_metadata.file_name"))
        parts.append(files.join(F.broadcast(bases), ["_f", "segment"])
                          .select("partition", (F.col("_base") + F.col("offset")).alias("offset"), "value", "timestamp"))
    if not parts:
        return literal_frame(spark, [], [("partition", "int"), ("offset", "long"), ("value", "string"), ("timestamp", "timestamp")])
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def literal_rows(spark: SparkSession, rows: list[tuple[str, int, int]]) -> DataFrame:
    """(_f, segment, _base) as a relation of literals."""
    return literal_frame(spark, rows, [("_f", "string"), ("segment", "int"), ("_base", "long")])


def _named(path: str, name: str | None, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(name or path.rstrip("/").rsplit("/", 1)[-1]).alias("topic"), "partition", "offset", "value", "timestamp")


def read_topic(spark: SparkSession, path: str, name: str | None = None, version: int | None = None) -> DataFrame:
    """All messages of a topic (of one version, the newest by default): topic, partition, offset, value, timestamp."""
    version = manifest.latest(spark, path) if version is None else version
    if version is None:
        return _named(path, name, spark.read.schema(TOPIC_SCHEMA).parquet(path))
    return _named(path, name, _of_files(spark, path, manifest.read(spark, path, version).collect()))


def topic_stats(topic: DataFrame) -> DataFrame:
    """Per partition oldest offset, high-water mark (last + 1) and count."""
    return topic.groupBy("topic", "partition").agg(
        F.min("offset").alias("oldest"),
        (F.max("offset") + 1).alias("hwm"),
        F.count(F.lit(1)).alias("records"),
    )


def stored_stats(spark: SparkSession, path: str, name: str | None = None, version: int | None = None) -> DataFrame:
    """A6 without reading a message: the same columns from the manifest of a version (the newest by default)."""
    rows = manifest.read(spark, path, version).groupBy("partition").agg(
        F.min("oldest").alias("oldest"), F.max("hwm").alias("hwm"), F.sum("records").alias("records"))
    return rows.select(F.lit(name or path.rstrip("/").rsplit("/", 1)[-1]).alias("topic"), "partition", "oldest", "hwm", "records")


def capture_bounds(spark: SparkSession, path: str, version: int | None = None) -> Bounds:
    """(partition, oldest, hwm) per partition, captured once, from the manifest."""
    return [(p, lo, hi) for p, lo, hi, _ in read_manifest(spark, path, version)]


def _of_partition(values: dict[int, int]) -> Column:
    """values[partition], 0 where absent; one entry per topic partition."""
    if not values:
        return F.lit(0).cast("long")
    table = F.create_map(*[x for p, v in sorted(values.items()) for x in (F.lit(p), F.lit(v).cast("long"))])
    return F.coalesce(F.try_element_at(table, F.col("partition")), F.lit(0).cast("long"))


def _any(conditions: list[Column]) -> Column:
    """Disjunction as a balanced tree (a chain would be as deep as there are partitions)."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def snapshot_read(spark: SparkSession, path: str, bounds: Bounds | None = None, name: str | None = None,
                  version: int | None = None) -> DataFrame:
    """A5: every message in [oldest, HWM) of each partition, bounds taken at call time.

    Only files that hold offsets inside the bounds are listed to the scan.  The bounds are literal predicates, one per distinct range
    (round-robin topics have two at most), and offsets are pushed down.  An append into an ordered topic moves
    offsets: give the ``version`` that the bounds were taken from.
    """
    version = manifest.latest(spark, path) if version is None else version
    bounds = capture_bounds(spark, path, version) if bounds is None else bounds
    ranges: dict[tuple[int, int], list[int]] = {}
    for p, lo, hi in bounds:
        ranges.setdefault((lo, hi), []).append(p)
    if version is None:
        t = read_topic(spark, path, name)
    else:
        # Only the manifest rows inside the bounds reach the driver.
        inside = [F.col("partition").isin(ps) & (F.col("oldest") < hi) & (F.col("hwm") > lo) for (lo, hi), ps in sorted(ranges.items())]
        rows = manifest.read(spark, path, version).where(_any(inside)).collect() if inside else []
        top = {p: hi for p, _, hi in bounds}
        cut = [top[r["partition"]] - r["base"] for r in rows if r["segment"] is not None]
        whole = all(top[r["partition"]] >= r["hwm"] for r in rows if r["segment"] is not None)
        t = _named(path, name, _of_files(spark, path, rows, None if whole or not cut else max(cut)))
    if not ranges:
        return t.where(F.lit(False))
    return t.where(_any([F.col("partition").isin(ps) & (F.col("offset") >= lo) & (F.col("offset") < hi)
                         for (lo, hi), ps in sorted(ranges.items())]))


def peek(spark: SparkSession, path: str, n: int = 10, name: str | None = None) -> DataFrame:
    """First ``n`` messages of every partition (bounds from the manifest, pushed to the scan)."""
    version = manifest.latest(spark, path)
    return snapshot_read(spark, path, [(p, lo, min(hi, lo + n)) for p, lo, hi in capture_bounds(spark, path, version)], name, version)


# -- publish -------------------------------------------------------------------------------

def line_counters() -> dict[str, Column]:
    """Counters over judged lines: read, and dropped by reason."""
    blank, few = F.col("_verdict") == "blank", F.col("_verdict") == "few"
    return {"read": F.count(F.lit(1)), "dropped_blank": F.count_if(blank), "dropped_few_fields": F.count_if(few)}


def publish_lines(lines: DataFrame, sink: Sink, partitions: int = 3, order: list[str] | None = None,
                  mode: str = "overwrite", value: str = "value", unique: bool = False, batch: str | None = None) -> dict:
    """A4: line filter -> round robin over ``partitions`` -> topic; returns the counters.

    Numbering follows ``order`` (columns of ``lines``; ``unique`` if no two rows agree in them) or
    arrival order, which takes no sort.  Lines are judged once and counted as they are: the kept ones are staged (arrival
    order: by the numbering itself).  ``append`` continues every partition's offsets at its high-water mark (A7);
    ``overwrite`` replaces the topic, which may be the one that ``lines`` come from.  A ``batch`` that the topic holds already is not
    written again.  ``sink``: a directory, or a function that writes a frame (``kafka_sink``).
    """
    spark = lines.sparkSession
    started = time.time()
    start: tuple[int | None, DataFrame] | None = (None, None)
    if isinstance(sink, str):
        start = _prepare(spark, sink, mode, batch)
        if start is None:
            return throughput({"read": 0, "dropped_blank": 0, "dropped_few_fields": 0, "sent": 0, "bytes": 0}, started)
    judged, read = observed(judge_lines(lines.select(value, *(order or [])), value), line_counters())
    rows = kept(judged)
    # A range sort reads its input twice (it samples it), so what it sorts is a staged copy.
    pos = numbered(stage(rows, "kept_lines") if order else rows, order, unique)
    msgs = pos.select(F.col(value).alias("value"), *round_robin_columns("_pos", partitions))
    shift = {}
    if isinstance(sink, str) and mode == "append" and start[0] is not None:
        shift = {p: hi for p, _, hi, _ in read_manifest(spark, sink, start[0])}
    msgs, sent = observed(msgs.withColumn("offset", F.col("offset") + _of_partition(shift)), sent_counters())
    if isinstance(sink, str):
        _commit_files(spark, sink, msgs, start[1], start[0], batch)
    else:
        sink(msgs)
    return throughput({**read.get, **sent.get}, started)


def publish_sorted(records: DataFrame, key: str, sink: Sink, mode: str = "overwrite",
                   columns: list[str] | None = None, tiebreak: tuple[str, ...] = SOURCE_POSITION,
                   fields: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Records in key order into one logical partition, offset = rank.

    One range exchange and sort, written as it comes: a file is a shard of the order and stores a row's place in it, the
    manifest gives the shard's first offset.  ``append`` keeps the order: shards whose range of keys holds no new key are
    listed again (later ones at higher offsets) and not read; the others are merged with the new records
    (``sources.ordered``; ``fields`` gives the columns of a message's ``value``, by default the record's four).
    """
    spark = records.sparkSession
    started = time.time()
    if not isinstance(sink, str):
        # A global offset needs the sizes of the shards before: a staged copy, as for any position.
        ranked = total_order(records, key, columns, tiebreak)
        cols = [c for c in ranked.columns if c != "offset"]
        msgs, sent = observed(ranked.select(serialize(cols).alias("value"), F.lit(0).alias("partition"), "offset"), sent_counters())
        sink(msgs)
        return throughput(sent.get, started)
    start = _prepare(spark, sink, mode)
    if start is None:
        return throughput({"sent": 0, "bytes": 0}, started)
    base, old = start
    if mode == "append" and base is not None and not old.isEmpty():
        counts, files = append_in_order(records, key, sink, old, columns, tiebreak, fields)
    else:
        counts, files = shard_files(records, key, sink, columns, tiebreak)
    manifest.commit(spark, sink, files, base)
    return throughput(counts, started)


# -- Kafka (needs the spark-sql-kafka package on the cluster; not installed here) --

def kafka_read(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str = "latest",
               options: dict[str, str] | None = None) -> DataFrame:
    """Bounded read of a Kafka topic (A5): earliest..latest captured at start."""
    reader = spark.read.format("kafka")
    for k, v in kafka_read_options(servers, topic, starting, ending, options).items():
        reader = reader.option(k, v)
    return (reader.load().select(F.lit(topic).alias("topic"), "partition", "offset",
                                 F.col("value").cast("string").alias("value"), "timestamp"))


def kafka_read_options(servers: str, topic: str, starting: str = "earliest", ending: str = "latest",
                       options: dict[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "endingOffsets": ending, **(options or {})}


def kafka_frame(msgs: DataFrame) -> DataFrame:
    """Rows as Kafka takes them.  The offset travels as the key, zero-padded: shards write one Kafka
    partition at the same time, so arrival order is not offset order; a reader sorts by the key and
    drops what an at-least-once retry doubled."""
    return msgs.select(F.lpad(F.col("offset").cast("string"), 19, "0").alias("key"),
                       F.col("value").cast("string").alias("value"), F.col("partition").cast("int").alias("partition"))


def kafka_sink(servers: str, topic: str, options: dict[str, str] | None = None) -> Callable[[DataFrame], None]:
    """A sink for ``publish_lines`` and ``publish_sorted``: writes to a Kafka topic."""
    def write(msgs: DataFrame) -> None:
        writer = kafka_frame(msgs).write.format("kafka")
        for k, v in {"kafka.bootstrap.servers": servers, "topic": topic, **(options or {})}.items():
            writer = writer.option(k, v)
        writer.save()

    return write
