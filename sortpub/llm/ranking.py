"""Ranks and running totals over a distributed order (no task holds more than a block)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortpub.operators.position import with_position

BLOCK_ROWS = 100_000


def running_total(df: DataFrame, order: list[Column | str], value: str, name: str,
                  block: int = BLOCK_ROWS) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are numbered, cut into blocks of ``block`` rows, and each block adds what all blocks
    before it hold (one row per block).
    """
    rows = with_position(df, order, "_at").withColumn("_block", F.expr(f"_at div {block}"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy("_block").agg(F.sum(value).alias("_sum"))
                 .select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_run", F.coalesce(F.sum(value).over(inside), F.lit(0)))
                .join(bases, "_block")
                .withColumn(name, F.col("_base") + F.col("_run"))
                .drop("_block", "_base", "_run", "_at"))
