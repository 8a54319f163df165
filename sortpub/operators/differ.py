"""Which records differ between two tables (as multisets of rows).

Both tables are summed up by ranges of their rows' 64-bit fingerprints: a count and an order-free sum for each
range.  Only ranges whose sums differ are looked at more closely, range by range 2 ** ``BITS`` times
smaller, and only the rows of the last differing ranges are shuffled as rows.  Equal tables cost one scan
each; a few differing records cost ``LEVELS`` scans and a shuffle of their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.session import stage

BITS = 10               # a level has 2 ** BITS times the ranges of the one above
LEVELS = 2
# Ranges up to this many go on to a scan as a broadcast list; with more the tables differ throughout and are compared as they are.
MAX_RANGES = 100_000


def _range(h: Column, level: int) -> Column:
    return F.shiftrightunsigned(h, 64 - BITS * level)


def _tagged(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """(row, h, side): side 1 for a row of ``before``, -1 for one of ``after``.  The caller's columns stay in one struct."""
    side = lambda df, n: df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.lit(n).cast("long").alias("side"))
    both = side(before, 1).unionByName(side(after, -1))
    return both.select("row", "side", F.xxhash64("row").alias("h"))


def differing_ranges(tagged: DataFrame, level: int, inside: DataFrame | None = None) -> DataFrame:
    """(r): ranges of ``level`` whose counts or fingerprint sums differ, among those in the ranges ``inside`` of the level above."""
    rows = tagged
    if inside is not None:
        rows = rows.withColumn("_up", _range(F.col("h"), level - 1)).join(F.broadcast(inside.withColumnRenamed("r", "_up")), "_up", "left_semi")
    # Fingerprints are summed as two halves, so that no sum of them overflows.
    low, high = F.col("h").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("h", 32)
    sums = rows.groupBy(_range(F.col("h"), level).alias("r")).agg(
        F.sum("side").alias("n"), F.sum(F.col("side") * low).alias("a"), F.sum(F.col("side") * high).alias("b"))
    return sums.where("n <> 0 or a <> 0 or b <> 0").select("r")


def differences(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(side, cols, times): rows that one side has ``times`` more often; side ``missing`` (from after) or ``extra``.

    Null values are equal to each other.
    """
    cols = cols or [c for c in before.columns if c in after.columns]
    tagged = _tagged(before, after, cols)
    ranges = None
    for level in range(1, LEVELS + 1):
        ranges = stage(differing_ranges(tagged, level, ranges), "ranges")
        if ranges.count() > MAX_RANGES:
            ranges = None
            break
    rows = tagged
    if ranges is not None:
        rows = tagged.withColumn("r", _range(F.col("h"), LEVELS)).join(F.broadcast(ranges), "r", "left_semi")
    times = rows.groupBy("row").agg(F.sum("side").alias("n")).where("n <> 0")
    return times.select(F.when(F.col("n") > 0, F.lit("missing")).otherwise(F.lit("extra")).alias("side"),
                        *[F.col(f"row.`{c}`").alias(c) for c in cols], F.abs("n").alias("times"))
