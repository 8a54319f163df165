"""Line files with a header line (line sink, line source).

Lines go through the text source and sink, so their content is kept exactly: quotes, commas, outer
spaces, '#', control characters.  A value that holds a line break or a NUL is no line; it goes
to the rejects, never into a file.  The first line of a file is its header, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.schema import HEADER, serialize
from sortpub.session import scratch_path

# Characters that can't stand inside a line, the longest line taken over, and its reject reason.
BREAKS = "[\\n\\r\\u0000]"
MAX_LINE_BYTES = 1 << 20
TOO_LONG = "too_long"
_ROW_MASK = (1 << 33) - 1


def is_line(value: str = "value") -> Column:
    return F.coalesce(~F.col(value).rlike(BREAKS), F.lit(False))


def unwritable(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows that ``write_lines`` leaves out: null, or with a line break or NUL inside."""
    return df.where(~is_line(value))


def _judged(df: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """(lines, rejects) of ``df``, from one evaluation: staged once, in a folder per verdict."""
    spark = df.sparkSession
    path = scratch_path(spark, "judged")
    taken = df.select(F.col(value).alias("value"))
    # The verdict stands in a projection above the value's, which is thus computed once.
    taken.select("value", is_line("value").cast("int").alias("_line")).write.partitionBy("_line").parquet(path)
    staged = spark.read.schema("value string, _line int").parquet(path)
    return staged.where("_line = 1").select("value"), staged.where("_line = 0").select("value")


def with_headers(lines: DataFrame, header: str, per_file: int = 0) -> DataFrame:
    """``header`` before the first line that a task writes, and before every line that begins a further file
    of ``per_file`` lines (0: a task writes one file)."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    first = (row % (per_file - 1) == 0) if per_file else row == 0
    rows = lines.select("value", first.alias("_first"))
    return rows.select(F.explode(F.when(F.col("_first"), F.array(F.lit(header), F.col("value"))).otherwise(F.array("value"))).alias("value"))


def write_lines(df: DataFrame, path: str, value: str = "value", header: str = HEADER, mode: str = "overwrite",
                rejects: str | None = None) -> str:
    """A2: a header line in every file, then the lines exactly as given.

    The source is computed once.  Rows that are no line are written to ``rejects`` (Parquet: ``value``); without it
    they raise before anything is written.  ``spark.sql.files.maxRecordsPerFile`` is kept to (the header counts):
    every file of a task has its header; a limit of 1 leaves no room for a line and raises.
    """
    spark = df.sparkSession
    per_file = int(spark.conf.get("spark.sql.files.maxRecordsPerFile"))
    if per_file == 1:
        raise ValueError("a file of one record holds its header only")
    lines, bad = _judged(df, value)
    if rejects:
        bad.write.mode(mode).parquet(rejects)
    elif not bad.isEmpty():
        raise ValueError("values hold line breaks, NUL or null; give a path for rejects")
    (with_headers(lines, header, max(per_file, 0)).write.mode(mode).option("lineSep", "\n")
        .option("maxRecordsPerFile", max(per_file, 0)).text(path))
    return path


def write_records(df: DataFrame, path: str, mode: str = "overwrite", rejects: str | None = None) -> str:
    """A2: serialise records (``id,name,address,continent``) and write them with the header."""
    return write_lines(df.select(serialize().alias("value")), path, mode=mode, rejects=rejects)


def drop_headers(raw: DataFrame) -> DataFrame:
    """Lines of a text scan (batch or stream) without each file's first line.

    The scan knows file and block of a row but no line number, and what a row follows inside
    its task has no built-in: this is the one step that runs as an Arrow batch function.  It
    drops the row that begins a new (file, block) at byte 0.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_before = start_before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            value, start, file = batch.column(0), batch.column(1), batch.column(2)
            starts = pa.concat_arrays([pa.array([start_before], pa.int64()), start.slice(0, len(start) - 1)])
            files = pa.concat_arrays([pa.array([file_before], pa.int64()), file.slice(0, len(file) - 1)])
            same = pc.fill_null(pc.and_(pc.equal(start, starts), pc.equal(file, files)), False)
            file_before, start_before = file[-1].as_py(), start[-1].as_py()
            yield pa.RecordBatch.from_arrays([value.filter(pc.or_(same, pc.not_equal(start, 0)))], names=["value"])

    return (raw.select("value", F.col("_metadata.file_block_start").alias("start"), F.xxhash64("_metadata.file_path").alias("file"))
               .mapInArrow(task, "value string"))


def not_blank(df: DataFrame) -> DataFrame:
    return df.where(F.trim("value") != "")


def read_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A3: one ``value`` row per non-blank line; the first line of each file is dropped.  Files stay splittable."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return not_blank(drop_headers(raw) if header else raw)


def bounded_lines(lines: DataFrame, max_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    """A3 with the bound on a line's length: (value, reject_reason); a line of more than ``max_bytes`` UTF-8 bytes is
    ``too_long``.  Route with ``kept_lines`` and ``long_lines``."""
    return lines.select("value", F.when(F.octet_length("value") > max_bytes, F.lit(TOO_LONG)).alias("reject_reason"))


def kept_lines(bounded: DataFrame) -> DataFrame:
    return bounded.where("reject_reason is null").select("value")


def long_lines(bounded: DataFrame) -> DataFrame:
    """(value_bytes, head, reject_reason): the size of every line beyond the bound and its first 100 characters."""
    return bounded.where("reject_reason is not null").select(
        F.octet_length("value").alias("value_bytes"), F.substring("value", 1, 100).alias("head"), "reject_reason")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """All lines, no header handling."""
    return spark.read.option("lineSep", "\n").text(path)
