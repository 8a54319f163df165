"""Stretches of text that recur: what suffix and phrase dedup share.

Documents are ordered by (doc_id, text hash); equal texts are stood for by their first document.
Winnowing gives every document its fingerprints.  Fingerprints travel to the part their hash names,
as arrays of 32-bit remainders; a fingerprint that several documents (or several places) have is
told back to the documents that hold it.  A remainder that collides only makes a candidate more:
what recurs is decided later, on the texts.

Each task first sums up what it holds (``GROUP_BYTES`` of text at a time): a fingerprint is sent once
per group with its count, however often it occurs there.  Parts grow in number with the text, so
none outgrows a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.llm import text as T
from sortpub.session import stage

GROUP_BYTES = 24 << 20
GROUP_ROWS = 50_000
PART_PRINTS = 400_000
# A copy list up to this many rows is broadcast, a longer one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
SALTS = 32
HOT_BIT = np.uint64(1 << 63)
DOC = ["d1", "d2"]

Prints = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, d1, d2, x1, x2, text): document order, text identity, text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    last = F.lit((1 << 63) - 1)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), last).alias("d1"),
                       F.xxhash64(text, F.col("doc_id").isNull()).alias("d2"),
                       F.xxhash64(text).alias("x1"), F.xxhash64(F.lit(1), text).alias("x2"), text.alias("text"))


def first_texts(rows: DataFrame, facts: list[Column]) -> tuple[DataFrame, DataFrame, int]:
    """(rows with ``facts`` and ``copy`` for the text, texts of first documents (d1, d2, text), their bytes).

    ``copy``: the same text stands in a document before.
    """
    T.small_batches(rows.sparkSession)
    size = F.octet_length("text").cast("long").alias("n_bytes")
    narrow = stage(rows.select("doc_id", *DOC, "x1", "x2", size, *facts), "narrow")
    firsts = (narrow.groupBy("x1", "x2").agg(F.min(F.struct(*DOC)).alias("_first"), F.count(F.lit(1)).alias("_n"))
                    .where("_n > 1").drop("_n"))
    # A text that a large part of the rows share meets its first document in SALTS places.
    salted = narrow.withColumn("_salt", F.pmod(F.xxhash64(*DOC), F.lit(SALTS)).cast("int"))
    spread = firsts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    narrow = stage(salted.join(spread, ["x1", "x2", "_salt"], "left")
                         .withColumn("copy", F.coalesce(F.struct(*DOC) > F.col("_first"), F.lit(False))).drop("_first", "_salt"), "flagged")
    copies = stage(narrow.where("copy").select(*DOC).distinct(), "copies")
    small = copies.count() <= BROADCAST_ROWS
    body = rows.select(*DOC, "text")
    firsts = body.join(F.broadcast(copies) if small else copies, DOC, "left_anti")
    return narrow, firsts, narrow.where("not copy").agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]


def parts(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.uint64)


def print_key(h: np.ndarray, n: int) -> np.ndarray:
    return (parts(h, n) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def task_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def starts_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def _send(prints: Prints, n: int, per_document: bool) -> Callable:
    def flush(group: int, held: list) -> Iterator[pa.RecordBatch]:
        d1, d2 = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        h, row = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held]).astype(np.uint32)
        key = print_key(h, n)
        order = np.argsort(key, kind="stable")           # rows stay in order inside a key
        key, row = key[order], row[order]
        if per_document and len(key):
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))
            key, row = key[new], row[new]
        start = starts_of(key)
        count = np.diff(np.append(start, len(key))).astype(np.uint32)
        again = np.repeat(count > 1, count)
        one, where = key[start], row[start]
        edge = np.searchsorted(one >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
        at = [p for p in range(n) if edge[p + 1] > edge[p]]
        cut = [slice(edge[p], edge[p + 1]) for p in at]
        low = (one & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        blobs = [[low[c].tobytes() for c in cut], [where[c].tobytes() for c in cut], [count[c].tobytes() for c in cut], [b""] * len(cut)]
        mine = (d1.tobytes(), d2.tobytes(), row[again].tobytes(), key[again].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at, -1 - group], pa.int64()), pa.array([group] * (len(at) + 1), pa.int64()),
             *(pa.array([*b, m], pa.binary()) for b, m in zip(blobs, mine))], names=["part", "g", "a", "b", "c", "d"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, size, rows = task_id() << 24, [], 0, 0
        for batch in T.chunks(batches):
            at, row, h = prints(batch.column(2))
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), h, row + rows))
            size, rows = size + batch.column(2).nbytes, rows + batch.num_rows
            if size > GROUP_BYTES or rows > GROUP_ROWS:
                yield from flush(group, held)
                group, held, size, rows = group + 1, [], 0, 0
        if held:
            yield from flush(group, held)

    return task


def _column(table: pa.Table, name: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), dtype=dtype) for b in table.column(name)]


def _answer(hot: int) -> Callable:
    """One part: which fingerprints occur twice or more, told back to their groups (kind 1).  What a
    group holds itself (part below 0) is passed on (kind 0)."""
    def task(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.select(["g", "a", "b", "c", "d"]).add_column(1, "kind", pa.array([0] * len(table), pa.int32()))
        part = np.uint64(key[0].as_py()) << np.uint64(32)
        low, row, count = _column(table, "a", np.uint32), _column(table, "b", np.uint32), _column(table, "c", np.uint32)
        groups = np.repeat(table.column("g").to_numpy(), [len(x) for x in low])
        low, row, count = np.concatenate(low), np.concatenate(row), np.concatenate(count)
        order = np.argsort(low, kind="stable")
        low, row, count, groups = low[order], row[order], count[order], groups[order]
        start = starts_of(low)
        total = np.add.reduceat(count.astype(np.int64), start)
        total = np.repeat(total, np.diff(np.append(start, len(low))))
        told = (total > 1) & ((count == 1) | (total > hot))
        keys = part | low.astype(np.uint64)
        keys[total > hot] |= HOT_BIT
        keys, row, groups, count = keys[told], row[told], groups[told], count[told]
        row = np.where(count > 1, np.uint32(0xFFFFFFFF), row)      # the group knows the rows
        order = np.argsort(groups, kind="stable")
        keys, row, groups = keys[order], row[order], groups[order]
        start = starts_of(groups)
        cut = [slice(a, b) for a, b in zip(start, np.append(start, len(groups))[1:])]
        return pa.table({"g": pa.array(groups[start], pa.int64()), "kind": pa.array([1] * len(cut), pa.int32()),
                         "a": pa.array([row[c].tobytes() for c in cut], pa.binary()), "b": pa.array([keys[c].tobytes() for c in cut], pa.binary()),
                         "c": pa.array([b""] * len(cut), pa.binary()), "d": pa.array([b""] * len(cut), pa.binary())})

    return task


def _assemble(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One group: its documents with their recurring fingerprints."""
    kind = table.column("kind").to_numpy()
    a, b, c, d = (table.column(x).to_pylist() for x in "abcd")
    own = int(np.flatnonzero(kind == 0)[0])
    d1, d2 = np.frombuffer(a[own], np.int64), np.frombuffer(b[own], np.int64)
    told = np.flatnonzero(kind == 1)
    rows = np.concatenate([np.frombuffer(c[own], np.uint32), *(np.frombuffer(a[i], np.uint32) for i in told)])
    keys = np.concatenate([np.frombuffer(d[own], np.uint64), *(np.frombuffer(b[i], np.uint64) for i in told)])
    mark = rows == 0xFFFFFFFF
    hot = np.unique(keys[mark])
    rows, keys = rows[~mark], keys[~mark]
    keys = np.where(np.isin(keys | HOT_BIT, hot), keys | HOT_BIT, keys)
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    start = starts_of(rows)
    cut = [slice(x, y) for x, y in zip(start, np.append(start, len(rows))[1:])]
    at = rows[start].astype(np.int64)
    return pa.table({"d1": pa.array(d1[at], pa.int64()), "d2": pa.array(d2[at], pa.int64()),
                     "keys": pa.array([np.unique(keys[x]).tobytes() for x in cut], pa.binary())})


def recurring(texts: DataFrame, prints: Prints, n_parts: int, hot: int, per_document: bool = False) -> DataFrame:
    """(d1, d2, keys): documents that hold fingerprints which occur twice or more, and which.

    ``per_document``: a document counts once.
    """
    sent = texts.select(*DOC, "text").mapInArrow(_send(prints, n_parts, per_document), "part long, g long, a binary, b binary, c binary, d binary")
    told = sent.groupBy("part").applyInArrow(_answer(hot), "g long, kind int, a binary, b binary, c binary, d binary")
    found = told.groupBy("g").applyInArrow(_assemble, "d1 long, d2 long, keys binary")
    return found.groupBy(*DOC).agg(F.collect_list("keys").alias("keys"))


def chosen(keys: list[bytes] | None, h: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a document's fingerprints: which recur, and which of these are hot."""
    have = np.frombuffer(b"".join(keys or []), dtype=np.uint64)
    mine = print_key(h, n_parts)
    hot = np.isin(mine | HOT_BIT, have)
    return hot | np.isin(mine, have), hot


# -- windows of hot fingerprints: exchanged by their own hash, so no group is large ----------

def pack_windows(h: np.ndarray, q: np.ndarray, r: np.ndarray, start: np.ndarray, n: int,
                 within: bool) -> tuple[list[int], list[bytes], np.ndarray]:
    """Windows (hash, order, document, start) -> (parts, blobs, later).

    ``later`` marks windows that an earlier one here equals (of a smaller order; with ``within``, of the same
    order and a smaller start as well); only the others are sent.
    """
    later = _later(h, q, start, within)
    keep = np.flatnonzero(~later)
    by = parts(h[keep], n)
    order = np.argsort(by, kind="stable")
    keep, by = keep[order], by[order]
    edge = starts_of(by)
    cut = [keep[a:b] for a, b in zip(edge, np.append(edge, len(by))[1:])]
    return [int(by[a]) for a in edge], [h[c].tobytes() + b"".join(x[c].astype(np.int64).tobytes() for x in (q, r, start)) for c in cut], later


def _later(h: np.ndarray, q: np.ndarray, start: np.ndarray, within: bool) -> np.ndarray:
    out = np.zeros(len(h), bool)
    order = np.lexsort((start, q, h))
    first = starts_of(h[order])
    if within:
        out[order] = True
        out[order[first]] = False
    else:
        least = np.repeat(q[order[first]], np.diff(np.append(first, len(h))))
        out[order] = q[order] > least
    return out


def later_windows(blobs: list[bytes], within: bool) -> tuple[np.ndarray, np.ndarray]:
    """One part of windows: (document, start) of those with an earlier equal one."""
    cols = [np.frombuffer(b, np.uint64).reshape(4, -1) for b in blobs]
    h, q, r, s = (np.concatenate([c[i] for c in cols]) for i in range(4))
    q, r, s = (x.astype(np.int64) for x in (q, r, s))
    later = _later(h, q, s, within)
    return r[later], s[later]


def merge_spans(r: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans [s, e) per document; spans that touch become one."""
    if not len(r):
        return r, s, e
    order = np.lexsort((s, r))
    r, s, e = r[order], s[order], e[order]
    far = int(e.max()) + 1
    reach = np.maximum.accumulate(e + (starts_rank(r) * far))
    base = starts_rank(r) * far
    new = np.ones(len(r), bool)
    new[1:] = (s[1:] + base[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return r[at], s[at], (reach - base)[np.append(at[1:], len(r)) - 1]


def starts_rank(sorted_values: np.ndarray) -> np.ndarray:
    """0, 0, 1, 1, 1, 2 ... for runs of equal values."""
    new = np.zeros(len(sorted_values), np.int64)
    new[starts_of(sorted_values)] = 1
    return np.cumsum(new) - 1
