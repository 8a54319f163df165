"""Total order, bucket order, rank within runs, merge, automatic choice, top-n.

Every order ends in a tie-break that splits copies: a hot key, or a group of identical rows, is
spread over many range partitions instead of landing in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortpub.operators.position import range_partitions, with_position
from sortpub.operators.profile import LOW_CARDINALITY_THRESHOLD, key_profile
from sortpub.schema import SOURCE_POSITION, check_key, serialize, sort_columns
from sortpub.session import stage

RUN_ROWS = 500_000


def _record_columns(df: DataFrame, columns: list[str] | None, tiebreak: tuple[str, ...]) -> list[str]:
    return list(columns) if columns is not None else [c for c in df.columns if c not in tiebreak]


def _with_tiebreak(df: DataFrame, cols: list[str], tiebreak: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``df`` and its columns that tell rows apart.

    Without any, rows are marked by their place in a staged copy: the files are fixed, so a
    retried task marks its rows as before.
    """
    present = [t for t in tiebreak if t in df.columns]
    if present:
        return df.select(*cols, *present), present
    return stage(df.select(*cols), "rows").withColumn("_mark", F.monotonically_increasing_id()), ["_mark"]


def total_order(df: DataFrame, key: str, columns: list[str] | None = None,
                tiebreak: tuple[str, ...] = SOURCE_POSITION, offset: str = "offset",
                partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` with ``offset`` = rank in (key, rest, tiebreak) order; nulls first.

    Range exchange and sort, then the global position of ``with_position``.
    """
    check_key(df, key)
    cols = _record_columns(df, columns, tiebreak)
    rows, present = _with_tiebreak(df, cols, tiebreak)
    order = sort_columns(rows, key, cols, tuple(present))
    ranked = with_position(rows, [F.col(c).asc() for c in order], name="_rank", partitions=partitions)
    return ranked.select(F.col("_rank").alias(offset), *cols)


def sorted_shards(df: DataFrame, key: str, columns: list[str] | None = None, tiebreak: tuple[str, ...] = SOURCE_POSITION,
                  partitions: int | None = None) -> tuple[DataFrame, list[str]]:
    """Rows of ``df`` range-partitioned and sorted as ``total_order`` ranks them (no offset yet), and the record columns."""
    check_key(df, key)
    cols = _record_columns(df, columns, tiebreak)
    rows, present = _with_tiebreak(df, cols, tiebreak)
    order = [F.col(c).asc() for c in sort_columns(rows, key, cols, tuple(present))]
    return rows.repartitionByRange(partitions or range_partitions(rows), *order).sortWithinPartitions(*order), cols


def bucket_order(df: DataFrame, key: str, columns: list[str] | None = None,
                 tiebreak: tuple[str, ...] = SOURCE_POSITION, offset: str = "offset",
                 partitions: int | None = None) -> DataFrame:
    """Buckets in key order (null first), order inside a bucket free.

    Inside a bucket rows stand by their hash, which is cheaper to compare than the whole
    record, and range partitions cut a large bucket at any hash; there is no per-bucket group.
    """
    check_key(df, key)
    cols = _record_columns(df, columns, tiebreak)
    rows, present = _with_tiebreak(df, cols, tiebreak)
    ranked = with_position(rows, [F.col(key).asc(), F.xxhash64(*cols), *present], name="_rank", partitions=partitions)
    return ranked.select(F.col("_rank").alias(offset), *cols)


def sort_auto(df: DataFrame, key: str, threshold: int = LOW_CARDINALITY_THRESHOLD,
              tiebreak: tuple[str, ...] = SOURCE_POSITION) -> tuple[str, DataFrame]:
    """The strategy verdict over the whole table, and the ordered rows.

    Both verdicts give the same order: the range sort splits few hot keys as well as many, so
    the verdict tells about the data and never changes the published table.
    """
    verdict = key_profile(df, key, threshold=threshold).first()["strategy"]
    return verdict, total_order(df, key, tiebreak=tiebreak)


def rank_in_runs(df: DataFrame, key: str, position: str = "position", rows: int = RUN_ROWS,
                 columns: list[str] | None = None) -> DataFrame:
    """Rank by ``key`` inside every ``rows`` consecutive positions.

    A window partition holds at most ``rows`` rows.
    """
    check_key(df, key)
    cols = [c for c in _record_columns(df, columns, ()) if c != position]
    order = [key, *[c for c in cols if c != key], position]
    w = Window.partitionBy("run").orderBy(*order)
    return (df.withColumn("run", F.expr(f"`{position}` div {rows}"))
              .withColumn("rank", F.row_number().over(w) - 1)
              .select("run", "rank", position, *cols))


def merge_runs(runs: list[DataFrame], key: str, columns: list[str] | None = None,
               tiebreak: tuple[str, ...] = SOURCE_POSITION, offset: str = "offset") -> DataFrame:
    """Several inputs into one order, duplicates kept: a union and one range sort."""
    merged = reduce(lambda a, b: a.unionByName(b), runs)
    return total_order(merged, key, columns, tiebreak, offset)


def sort_all_keys(parsed: DataFrame, keys: list[str] | tuple[str, ...] = ("id", "name", "continent"),
                  columns: list[str] | None = None, tiebreak: tuple[str, ...] = SOURCE_POSITION) -> DataFrame:
    """One parse, every key: (sort_key, offset, value) for each ordered output."""
    for k in keys:
        check_key(parsed, k)
    shared = stage(parsed, "parsed")
    cols = _record_columns(shared, columns, tiebreak)
    outs = [
        total_order(shared, k, cols, tiebreak).select(F.lit(k).alias("sort_key"), "offset", serialize(cols).alias("value"))
        for k in keys
    ]
    return reduce(lambda a, b: a.unionByName(b), outs)


def top_n(df: DataFrame, key: str, n: int, columns: list[str] | None = None,
          tiebreak: tuple[str, ...] = SOURCE_POSITION, offset: str = "offset") -> DataFrame:
    """First ``n`` rows in key order (TakeOrderedAndProject, no full sort)."""
    cols = _record_columns(df, columns, tiebreak)
    order = [F.col(c).asc() for c in sort_columns(df, key, cols, tiebreak)]
    head = df.orderBy(*order).limit(n)
    # At most n rows reach this window: the limit is the feature.
    return head.withColumn(offset, F.row_number().over(Window.orderBy(*order)) - 1).select(offset, *cols)
