"""G1 into a topic: a bounded stream whose batches are commits, and its counters.

``foreachBatch`` may hand a batch over again after a failure.  Each batch's commit carries the stream's name and the batch
number in the manifest; a batch that the topic holds already is left out, so a replay adds no row.  Offsets are
given per batch, from the high-water mark of the version the batch builds on.

A batch costs jobs and a commit however few lines it holds, so the files of a batch follow the backlog
(``files_per_batch``): the number of batches doesn't grow with the files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sortpub.session import scratch_path
from sortpub.sources import topic

# Batches that a bounded stream takes for the files it finds.
MAX_BATCHES = 16


def batch_name(stream: str, number: int) -> str:
    return f"{stream}:{number}"


def append_batch(rows: DataFrame, number: int, path: str, stream: str, partitions: int = 3, value: str = "value") -> dict:
    """One batch as one commit; nothing if the topic holds it already."""
    return topic.publish_lines(rows, path, partitions, mode="append", value=value, batch=batch_name(stream, number))


def stream_to_topic(stream: DataFrame, path: str, name: str, partitions: int = 3, checkpoint: str | None = None,
                    each: Callable[[DataFrame, int], None] | None = None) -> int:
    """Run a streaming frame of lines (``value``) into the topic until what is there now has been read; returns the number of batches.

    ``name`` tells this stream's batches from another's; keep it together with ``checkpoint``.
    """
    spark = stream.sparkSession
    numbers = set()

    def commit(rows: DataFrame, number: int) -> None:
        append_batch(rows, number, path, name, partitions)
        numbers.add(number)
        if each:
            each(rows, number)

    query = (stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint or scratch_path(spark, "stream_checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return len(numbers)


class Counters(StreamingQueryListener):
    """Sums of the counters that a stream observes under ``name``, one entry per batch.

    Counters come with the progress of a batch; a batch that is reported again replaces its entry.
    """

    def __init__(self, name: str):
        self.name, self.batches = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches[event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self, spark: SparkSession, wait_ms: int = 60_000) -> dict[str, int]:
        """Sums over the batches so far; progress is reported behind the stream, so the reports under way are waited for."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(wait_ms)
        names = sorted({n for b in self.batches.values() for n in b})
        return {n: sum(b.get(n) or 0 for b in self.batches.values()) for n in names}


def observed_stream(stream: DataFrame, counters: dict[str, Column], name: str = "lines") -> tuple[DataFrame, Counters]:
    """E3 on a stream: the frame with counters attached, and the listener (registered) that gathers them per batch."""
    listener = Counters(name)
    stream.sparkSession.streams.addListener(listener)
    return stream.observe(name, *[c.alias(n) for n, c in counters.items()]), listener


def files_per_batch(spark: SparkSession, source_dir: str, least: int = 1, batches: int = MAX_BATCHES) -> int:
    """Files a trigger should take: ``least``, or as many more as bring the files there now into ``batches`` batches.

    A share of the files, so no file is left out.  The listing is the one the stream makes itself, and only its length is fetched.
    """
    files = len(spark.read.format("text").load(source_dir)._jdf.inputFiles())
    return max(least, -(-files // batches))


def line_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files in a folder as a stream (first line of each file kept).

    ``max_files``: files a trigger takes at most; ``files_per_batch`` gives one that holds for any backlog.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n").schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source_dir).where(F.trim("value") != "")
