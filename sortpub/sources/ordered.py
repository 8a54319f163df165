"""Files of ordered topics: writing shards, and merging new records into the order.

A shard is the part of an order that one file holds (of a merged file: one segment of it).  Its manifest row keeps
its first and last key.  An append finds the shards whose range of keys holds a new key, merges these with the new
records, and lists all others again: the ones behind at higher offsets, which is a new ``base`` in the
manifest and no byte of data.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortpub.operators import parse
from sortpub.operators.metrics import observed, sent_counters
from sortpub.operators.order import sorted_shards
from sortpub.operators.position import range_partitions
from sortpub.schema import RECORD_COLUMNS, SOURCE_POSITION, check_key, serialize
from sortpub.session import literal_frame, stage
from sortpub.sources import manifest

_ROW_MASK = (1 << 33) - 1


def _write_shards(rows: DataFrame, path: str, key: Column, segment: Column) -> tuple[dict, DataFrame]:
    """Write sorted ``rows`` (with a ``value``), a file per task; counters, and (path, segment, part, first row, records, first and last key).

    ``part``: the task's number, which is the shard's place in the order.
    """
    spark = rows.sparkSession
    folder, target = manifest.begin(path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    msgs, sent = observed(rows.select("value", F.lit(None).cast("timestamp").alias("timestamp"), place.alias("offset"),
                                      F.lit(0).alias("partition"), key.alias("key"), segment.cast("int").alias("segment"),
                                      F.spark_partition_id().alias("part")), sent_counters())
    msgs.write.option("maxRecordsPerFile", 0).parquet(target)       # the place in the task is the place in the file
    files = spark.read.schema(msgs.schema).parquet(target)
    shards = files.groupBy(F.col("_metadata.file_name").alias("_f"), "segment", "part").agg(
        F.min("offset").alias("at"), F.count(F.lit(1)).alias("records"), F.min("key").alias("_first"), F.max("key").alias("_last"),
        F.count("key").alias("_keys"))
    # Null keys stand first; min and max pass over them.
    first = F.when(F.col("_keys") == F.col("records"), F.col("_first").cast("string"))
    return sent.get, shards.select(F.concat(F.lit(f"{folder}/"), "_f").alias("path"), "segment", "part", "at", "records",
                                   first.alias("first_key"), F.col("_last").cast("string").alias("last_key"))


def _listed(spark: SparkSession, shards: list[dict], sort_key: str) -> DataFrame:
    """Manifest rows of shards in their order."""
    out, at = [], 0
    for i, s in enumerate(shards):
        out.append((s["path"], 0, i, s["segment"], at - s["at"], at, at + s["records"], s["records"], sort_key, s["first_key"], s["last_key"], None))
        at += s["records"]
    return literal_frame(spark, out, manifest.SCHEMA)


def shard_files(records: DataFrame, key: str, path: str, columns: list[str] | None = None,
                tiebreak: tuple[str, ...] = SOURCE_POSITION) -> tuple[dict, DataFrame]:
    """Counters and manifest rows of ``records`` written in order.  One row per file reaches the driver."""
    rows, cols = sorted_shards(records, key, columns, tiebreak)
    sent, shards = _write_shards(rows.select(serialize(cols).alias("value"), F.col(key).alias("_key")), path, F.col("_key"), F.lit(0))
    return sent, _listed(records.sparkSession, [r.asDict() for r in shards.orderBy("part").collect()], key)


# -- append ------------------------------------------------------------------------------

def _comparable(kind: T.DataType) -> Callable[[str], object]:
    """Key text from the manifest as a value that Python orders as Spark orders the column."""
    if isinstance(kind, T.IntegralType):
        return int
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float
    if isinstance(kind, (T.StringType, T.DateType)):
        return str
    raise ValueError(f"no append into an order by a key of type {kind.simpleString()}")


class Zones:
    """Key ranges of the shards, ascending; a null key stands before all others."""

    def __init__(self, shards: list[dict], kind: T.DataType):
        value = _comparable(kind)
        key = lambda x: (0, 0) if x is None else (1, value(x))
        self.first = [key(s["first_key"]) for s in shards]
        self.last = [key(s["last_key"]) for s in shards]
        self.text = isinstance(kind, T.DateType)

    def place(self, key) -> tuple[int, int]:
        """(i, j): shards i to j - 1 hold the key in their range; none if i == j, and shard i is the first behind it."""
        k = (0, 0) if key is None else (1, str(key) if self.text else key)
        i = bisect.bisect_left(self.last, k)
        return i, max(i, bisect.bisect_right(self.first, k))


def _placed(rows: DataFrame, key: str, zones: Zones) -> DataFrame:
    """``rows`` with ``_i`` and ``_j`` (``Zones.place`` of their key), by binary search in Arrow batches."""
    at = rows.columns.index(key)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zones.place(k) for k in batch.column(at).to_pylist()]
            columns = [*batch.columns, *(pa.array([f[n] for f in found], pa.int32()) for n in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_i", "_j"])

    return rows.mapInArrow(task, T.StructType([*rows.schema, T.StructField("_i", T.IntegerType()), T.StructField("_j", T.IntegerType())]))


def record_fields(messages: DataFrame) -> DataFrame:
    """The record's four columns of each message's ``value``, which stays as it is (null where it doesn't parse)."""
    return parse.parse(messages, keep=[c for c in messages.columns if c != "value"]).drop("reject_reason")


def append_in_order(records: DataFrame, key: str, path: str, old: DataFrame, columns: list[str] | None = None,
                    tiebreak: tuple[str, ...] = SOURCE_POSITION,
                    fields: Callable[[DataFrame], DataFrame] | None = None) -> tuple[dict, DataFrame]:
    """Counters and manifest rows after ``records`` have joined an ordered topic (``old``: its manifest rows).

    The driver holds one row per shard.  Old messages keep their text; among equal records the old stand first.
    """
    spark = records.sparkSession
    check_key(records, key)
    cols = list(columns) if columns is not None else [c for c in records.columns if c not in tiebreak]
    shards = [r.asDict() for r in old.orderBy("shard").collect()]
    if any(s["sort_key"] != key for s in shards):
        raise ValueError(f"{path} is no topic in order of {key!r}")
    if fields is None and cols != RECORD_COLUMNS:
        raise ValueError("give fields= for messages other than the four-column record")
    kind = records.schema[key].dataType
    new = stage(_placed(records.select(*cols), key, Zones(shards, kind)), "appended")
    hit = {n for r in new.where("_i < _j").select("_i", "_j").distinct().collect() for n in range(r["_i"], r["_j"])}

    # Rows between the same untouched shards make a segment; its number counts the untouched ones before it.
    before = [0]
    for i in range(len(shards)):
        before.append(before[-1] + (i not in hit))
    segment = literal_frame(spark, list(enumerate(before)), [("_i", "int"), ("_segment", "int")])
    both = (new.join(F.broadcast(segment), "_i").select(*cols, serialize(cols).alias("value"), "_segment", F.lit(1).alias("_new")))
    if hit:
        both = both.unionByName(_old_messages(spark, path, [(shards[i], before[i]) for i in sorted(hit)], fields or record_fields, cols))
    # The mark splits groups of copies between tasks; the staged files fix it.
    both = stage(both, "merged").withColumn("_mark", F.monotonically_increasing_id())
    order = [F.col(c) for c in ("_segment", key, *[c for c in cols if c != key], "_new", "_mark")]
    lined = both.repartitionByRange(range_partitions(both), *order).sortWithinPartitions(*order)
    sent, made = _write_shards(lined.select("value", F.col(key).alias("_key"), "_segment"), path, F.col("_key"), F.col("_segment"))
    made = [r.asDict() for r in made.orderBy("segment", "part").collect()]
    kept = [{**s, "at": s["oldest"] - s["base"], "_at": before[i]} for i, s in enumerate(shards) if i not in hit]
    # A segment stands before the untouched shard of its number.
    line = sorted([(s["segment"], 0, s["part"], s) for s in made] + [(s["_at"], 1, 0, s) for s in kept], key=lambda x: x[:3])
    merged = sum(shards[i]["records"] for i in hit)
    bytes_new = both.where("_new = 1").agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()[0]
    return {"sent": sent["sent"] - merged, "bytes": bytes_new}, _listed(spark, [x[3] for x in line], key)


def _old_messages(spark: SparkSession, path: str, shards: list[tuple[dict, int]],
                  fields: Callable[[DataFrame], DataFrame], cols: list[str]) -> DataFrame:
    """Messages of the given shards with their record columns and the segment they merge into."""
    root = path.rstrip("/")
    files = spark.read.schema("value string, segment int").parquet(*[f"{root}/{p}" for p in sorted({s["path"] for s, _ in shards})])
    listed = literal_frame(spark, [(s["path"].rsplit("/", 1)[1], s["segment"], at) for s, at in shards], [("_f", "string"), ("segment", "int"), ("_segment", "int")])
    rows = files.withColumn("_f", F.col("_metadata.file_name")).join(F.broadcast(listed), ["_f", "segment"])
    return fields(rows.select("value", "_segment")).select(*cols, "value", "_segment", F.lit(0).alias("_new"))
