"""An order published to Kafka: partition = shards that follow each other.

The records are cut into as many ranges of the order as their size asks for (``SHARD_BYTES``).  A partition of the topic
takes the same number of neighbouring ranges, so the partitions read one after the other are the whole order.  The messages
go out in waves: a wave sends some shards of every partition, each partition in order by one task, and the next wave
follows when it is through.  So neither a sort nor a sending task grows with the table.  The bounds (first offset,
records, first and last key of every partition) are kept beside the topic as a small table, without
which no reader could tell an offset of the whole order.

A message's key is its place in its partition, zero-padded.  What is sent is a staged copy: a task that is
tried again sends the same messages at the same places, and readers drop the doubles by (partition, place).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortpub.operators.metrics import throughput
from sortpub.operators.order import sorted_shards
from sortpub.schema import SOURCE_POSITION, check_key, serialize
from sortpub.session import stage

PLACE_DIGITS = 19
# Bytes of values per shard, and that a wave sends to a partition.
SHARD_BYTES = 64 << 20
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def ordered_messages(records: DataFrame, key: str, partitions: int, columns: list[str] | None = None,
                     tiebreak: tuple[str, ...] = SOURCE_POSITION) -> DataFrame:
    """(partition, shard, place, value, sort_key), staged: partition p holds the p-th run of neighbouring ranges of the
    order, ``shard`` counts them from 0 in it, ``place`` the messages.
    """
    check_key(records, key)
    # A range sort reads its input twice (it samples it), so what it sorts is a staged copy, which also tells the size.
    taken = stage(records, "records")
    shown = list(columns) if columns is not None else [c for c in taken.columns if c not in tiebreak]
    value_bytes = taken.agg(F.coalesce(F.sum(F.octet_length(serialize(shown))), F.lit(0))).first()[0]
    shards = max(taken.sparkSession.sparkContext.defaultParallelism, -(-value_bytes // SHARD_BYTES))
    each = -(-shards // partitions)
    rows, cols = sorted_shards(taken, key, columns, tiebreak, partitions * each)
    mark = F.monotonically_increasing_id()
    range_id = F.shiftright(mark, _ROW_BITS)
    ranges = rows.select((range_id / each).cast("int").alias("partition"), (range_id % each).cast("int").alias("shard"),
                         mark.bitwiseAND(F.lit(_ROW_MASK)).alias("i"), serialize(cols).alias("value"), F.col(key).alias("sort_key"))
    staged = stage(ranges, "ordered")
    before = Window.partitionBy("partition").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)       # one row a shard
    counts = staged.groupBy("partition", "shard").agg(F.count(F.lit(1)).alias("n"))
    firsts = stage(counts.select("partition", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "firsts")
    return (staged.join(F.broadcast(firsts), ["partition", "shard"])
                  .select("partition", "shard", (F.col("first") + F.col("i")).alias("place"), "value", "sort_key"))


def partition_bounds(messages: DataFrame) -> DataFrame:
    """(partition, base, records, first_key, last_key): one row a partition that holds messages."""
    counts = messages.groupBy("partition").agg(F.count(F.lit(1)).alias("records"), F.min("sort_key").alias("first_key"), F.max("sort_key").alias("last_key"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)       # one row a partition
    return counts.select("partition", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("base"), "records", "first_key", "last_key")


def to_send(messages: DataFrame, partitions: int) -> DataFrame:
    """(key, value, partition) as Kafka takes them: a partition's messages in one task of their own, in order."""
    lined = messages.repartitionById(partitions, "partition").sortWithinPartitions("partition", "place")
    return lined.select(F.lpad(F.col("place").cast("string"), PLACE_DIGITS, "0").alias("key"), "value", "partition")


def waves(messages: DataFrame, partitions: int, value_bytes: int, shards: int) -> list[DataFrame]:
    """``messages`` cut into waves of whole shards, first places first, about ``SHARD_BYTES`` of values to a partition each.

    A file of the staged copy holds one shard, so a wave skips the others' rows by their statistics.
    """
    asked = max(1, -(-value_bytes // (partitions * SHARD_BYTES)))
    step = max(1, shards // asked)
    return [messages.where((F.col("shard") >= lo) & (F.col("shard") < lo + step)) for lo in range(0, max(shards, 1), step)]


def publish_in_order(records: DataFrame, key: str, send: Callable[[DataFrame], None], partitions: int, bounds_path: str,
                     columns: list[str] | None = None, tiebreak: tuple[str, ...] = SOURCE_POSITION) -> dict:
    """Send ``records`` in ``key`` order over ``partitions`` partitions and write their bounds (Parquet).

    ``send`` writes a frame of (key, value, partition), e.g. ``kafka_writer``; it is called once a wave and adds to what it
    wrote before.  The bounds are written first: a reader of a half-sent topic finds fewer messages than they tell.
    """
    started = time.time()
    messages = ordered_messages(records, key, partitions, columns, tiebreak)
    bounds = stage(partition_bounds(messages), "bounds")
    bounds.write.mode("overwrite").parquet(bounds_path)
    counts = messages.agg(F.count(F.lit(1)).alias("sent"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
                          F.coalesce(F.max("shard") + 1, F.lit(0)).alias("shards")).first().asDict()
    for wave in waves(messages, partitions, counts["bytes"], counts.pop("shards")):
        send(to_send(wave, partitions))
    return throughput(counts, started)


def writer_options(servers: str, topic: str, options: dict[str, str] | None = None) -> dict[str, str]:
    """Producer settings that keep a task's messages in order through the client's own retries."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.enable.idempotence": "true", "kafka.acks": "all",
            **(options or {})}


def kafka_writer(servers: str, topic: str, options: dict[str, str] | None = None) -> Callable[[DataFrame], None]:
    """``send`` for a Kafka topic (needs the spark-sql-kafka package on the cluster; not installed here)."""
    def send(frame: DataFrame) -> None:
        writer = frame.write.format("kafka")
        for k, v in writer_options(servers, topic, options).items():
            writer = writer.option(k, v)
        writer.save()

    return send


def read_in_order(spark: SparkSession, received: DataFrame, bounds_path: str) -> DataFrame:
    """(offset, value) of messages (key, value, partition) as received, doubles dropped; sort by offset for the order."""
    bounds = spark.read.parquet(bounds_path).select("partition", "base", "records")
    place = F.col("key").cast("string").cast("long")
    once = received.select("partition", place.alias("place"), F.col("value").cast("string").alias("value")).dropDuplicates(["partition", "place"])
    return once.join(F.broadcast(bounds), "partition").select((F.col("base") + F.col("place")).alias("offset"), "value")


def missing(spark: SparkSession, received: DataFrame, bounds_path: str) -> DataFrame:
    """(partition, expected, received): partitions that hold fewer messages than their bounds tell."""
    got = received.select("partition", "key").distinct().groupBy("partition").agg(F.count(F.lit(1)).alias("received"))
    bounds = spark.read.parquet(bounds_path).select("partition", F.col("records").alias("expected"))
    return bounds.join(got, "partition", "left").select("partition", "expected", F.coalesce("received", F.lit(0)).alias("received")).where("expected <> received")
