"""Round-robin spread and per-key bucket routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.operators.position import with_position
from sortpub.schema import check_key
from sortpub.session import stage


def round_robin_columns(position: str, n: int) -> tuple[Column, Column]:
    """Counter mod n -> (partition, offset within the partition)."""
    if n < 1:
        raise ValueError("partition count must be >= 1")
    return (F.expr(f"cast(pmod(`{position}`, {n}) as int)").alias("partition"),
            F.expr(f"`{position}` div {n}").alias("offset"))


def numbered(df: DataFrame, order: list[str] | None, unique: bool, name: str = "_pos") -> DataFrame:
    """Rows with their number in ``order`` (or arrival order, without a sort, if None).

    ``unique``: no two rows agree in ``order``.  Otherwise a hot value is split by the rows'
    hash and their place in a staged copy.
    """
    if not order:
        return with_position(df, None, name)
    keys = [F.col(c).asc() for c in order]
    if unique:
        return with_position(df, keys, name)
    marked = stage(df, "rows").withColumn("_mark", F.monotonically_increasing_id())
    return with_position(marked, [*keys, F.xxhash64(*df.columns), "_mark"], name).drop("_mark")


def round_robin(df: DataFrame, n: int, order: list[str] | None = None, unique: bool = False) -> DataFrame:
    """C1 with deterministic numbering: position in ``order`` or arrival order."""
    pos = numbered(df, order, unique)
    return pos.select(*round_robin_columns("_pos", n), *df.columns)


def round_robin_layout(df: DataFrame, n: int) -> DataFrame:
    """C1 as physical layout only: RoundRobinPartitioning into n partitions."""
    return df.repartition(n)


def bucket_route(df: DataFrame, key: str, path: str, mode: str = "overwrite") -> str:
    """Route each record to its key's bucket directory.

    The rebalance hint brings a key's rows together and splits a hot key by size at run time,
    so no salt is needed; the key is kept as a data column as well (directory names collapse
    '' and null).
    """
    check_key(df, key)
    bucket_col = f"_bucket_{key}"
    (df.withColumn(bucket_col, F.col(key).cast("string"))
       .hint("rebalance", F.col(bucket_col))
       .write.mode(mode).partitionBy(bucket_col).parquet(path))
    return path


def read_buckets(spark, path: str, key: str) -> DataFrame:
    """Read routed buckets back; the bucket directory column is dropped (key is in the data)."""
    return spark.read.parquet(path).drop(f"_bucket_{key}")
