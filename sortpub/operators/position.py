"""Global position (rank) of every row without a single-partition step.

The rows are range-partitioned and sorted (or taken in their present order), and written
once under the shared scratch folder together with the partition number ``_p`` and the row
index ``_i`` inside it.  Everything later reads that one copy: a count per partition (a scan
of two small columns), prefix sums over the counts (one row per partition), and
``position = base(_p) + _i``.  Nothing is cached, no later run can see stale rows, and a lost
executor costs a re-read only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortpub.session import stage

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
# Bytes of input per range partition.
PARTITION_BYTES = 128 << 20
# The base table has one row per partition; it is broadcast up to this many, joined beyond.
MAX_BROADCAST_PARTITIONS = 1_000_000
_UNKNOWN_BYTES = 1 << 60


def _physical_scan_bytes(plan) -> int:
    total = 0
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        name = leaf.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            total += int(leaf.relation().sizeInBytes())
        elif name == "InMemoryTableScanExec":
            total += _physical_scan_bytes(leaf.relation().cacheBuilder().cachedPlan())
        elif name == "AdaptiveSparkPlanExec":
            total += _physical_scan_bytes(leaf.inputPlan())
        elif name == "RDDScanExec":
            total += PARTITION_BYTES * int(leaf.rdd().getNumPartitions())
    return total


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the sources ``df`` reads (through cached plans).

    Source sizes, not the optimizer's estimate of the result: without column statistics an
    inner join is estimated as the product of its inputs.  A checkpointed or RDD-backed
    frame counts its partitions.  A source that states no size raises; the caller then
    gives the partition count.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        name = leaf.getClass().getSimpleName()
        if name == "LogicalRelation":
            total += int(leaf.relation().sizeInBytes())
        elif name == "InMemoryRelation":
            total += _physical_scan_bytes(leaf.cacheBuilder().cachedPlan())
        elif name == "LogicalRDD":
            total += PARTITION_BYTES * int(leaf.rdd().getNumPartitions())
        else:
            size = int(str(leaf.stats().sizeInBytes()))
            if size >= _UNKNOWN_BYTES:
                raise ValueError(f"{name} states no size; pass partitions=")
            total += size
    return total


def range_partitions(df: DataFrame, bytes_per_partition: int = PARTITION_BYTES) -> int:
    """Range partitions for a sort of ``df``: one per ``bytes_per_partition`` of input,
    at least the default parallelism."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-scan_bytes(df) // bytes_per_partition))


def with_position(df: DataFrame, order: list[Column | str] | None = None, name: str = "position",
                  partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0..N-1 in ``order`` (or in present partition order if None); a column of that name is replaced.

    With ``order`` the staged copy is range-partitioned and sorted inside each partition.
    The order should be total up to identical rows; rows that tie keep one repeatable
    position each, because the staged copy fixes it.
    """
    body = df
    if order:
        partitions = partitions or range_partitions(df)
        body = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    else:
        partitions = df.rdd.getNumPartitions()
    mark = F.monotonically_increasing_id()
    # The caller's columns travel in one struct, so none of them can clash with the marks.
    held = [c for c in df.columns if c != name]
    row = F.struct(*[F.col(f"`{c}`") for c in held]) if held else F.struct(F.lit(0).alias("_none"))
    staged = stage(body.select(row.alias("row"), F.shiftright(mark, _ROW_BITS).alias("p"), mark.bitwiseAND(F.lit(_ROW_MASK)).alias("i")),
                   f"position_{name}")
    counts = staged.groupBy("p").agg((F.max("i") + 1).alias("n"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if partitions <= MAX_BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    return staged.join(bases, "p").select(*[F.col(f"row.`{c}`").alias(c) for c in held], (F.col("base") + F.col("i")).alias(name))
