"""G1: consume everything present now, then stop (``trigger(availableNow=True)``).

The stream lands in a staging table through the exactly-once file sink (its commit
log lists only finished batches, so a replayed batch never doubles rows); ordering is
a batch step afterwards, since a streaming sort in append mode is not allowed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sortpub.session import scratch_path
from sortpub.sources.lines import drop_headers, not_blank


def stream_snapshot(spark: SparkSession, source_dir: str, schema: str, fmt: str = "parquet",
                    glob: str | None = None, staging: str | None = None,
                    max_files_per_trigger: int | None = None, options: dict | None = None,
                    transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a bounded stream over ``source_dir`` (through ``transform``) and return the staged rows."""
    staging = staging or scratch_path(spark, "stream_staging")
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    rows = reader.load(source_dir)
    rows = transform(rows) if transform else rows
    q = (rows.writeStream.format("parquet")
         .option("path", f"{staging}/data").option("checkpointLocation", f"{staging}/_checkpoint")
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return spark.read.schema(rows.schema).parquet(f"{staging}/data")


def stream_lines(spark: SparkSession, source_dir: str, header: bool = True,
                 staging: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """G1 over line files: every line present now (first line of each file dropped), then stop."""
    keep = (lambda raw: not_blank(drop_headers(raw))) if header else not_blank
    return stream_snapshot(spark, source_dir, "value string", fmt="text", staging=staging,
                           max_files_per_trigger=max_files_per_trigger, options={"lineSep": "\n"}, transform=keep)
