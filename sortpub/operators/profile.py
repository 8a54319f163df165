"""Key profile, bucket counts, run statistics: aggregates over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.schema import check_key

# Fixed value: strictly fewer distinct keys than this are few (verdict ``bucket``).
LOW_CARDINALITY_THRESHOLD = 200


def key_profile(df: DataFrame, key: str, threshold: int = LOW_CARDINALITY_THRESHOLD) -> DataFrame:
    """Rows, distinct keys (null is none) and the strategy verdict, one row.

    Counted per key first: a hot key is summed up before the shuffle.
    """
    counts = bucket_counts(df, key)
    return counts.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("rows"), F.count(F.col(key)).alias("distinct_keys"),
    ).select(
        F.lit(key).alias("sort_key"), "rows", "distinct_keys",
        F.when(F.col("distinct_keys") < threshold, F.lit("bucket")).otherwise(F.lit("merge")).alias("strategy"),
    )


def key_profile_approx(df: DataFrame, key: str, rsd: float = 0.05) -> DataFrame:
    """E1 without a shuffle of keys: HyperLogLog estimate of the distinct keys."""
    check_key(df, key)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(key, rsd).alias("approx_distinct_keys"))


def bucket_counts(df: DataFrame, key: str) -> DataFrame:
    """Records per key value (the row count is the number of buckets)."""
    check_key(df, key)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("records"))


def run_stats(runs: DataFrame, key: str, run: str = "run") -> DataFrame:
    """Records and key range per run."""
    return runs.groupBy(run).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )
