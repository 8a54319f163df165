"""Vectorised byte and word helpers over Arrow text columns (used inside Arrow tasks).

A word is ``[^\\x20\\x09-\\x0D]+`` in the UTF-8 bytes.  Hashes are polynomials modulo 2**64
over seeded byte values, taken from prefix sums, so the hash of any slice costs two lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

IS_SEP = np.zeros(256, dtype=bool)
IS_SEP[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def small_batches(spark, rows: int = 1_000) -> None:
    """Lower the session's Arrow batch size to ``rows`` (it is never raised): at Spark's default of
    10,000, long texts make batches that weigh on an executor's memory outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix steps)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n 64-bit values that follow from the seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=_U) + _U(1)) * _U(_BASE) + _U(seed))


_BYTE = seeded(256, 11)
_POW = np.ones(1, dtype=_U)
_INV = np.ones(1, dtype=_U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << (n - 1).bit_length()
        _POW, _INV = np.full(size, _BASE, dtype=_U), np.full(size, _BASE_INV, dtype=_U)
        _POW[0] = _INV[0] = 1
        np.multiply.accumulate(_POW, out=_POW)
        np.multiply.accumulate(_INV, out=_INV)
    return _POW[:n], _INV[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i, one longer than ``values``."""
    out = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * _powers(len(values) + 1)[0][:-1], out=out[1:])
    return out


def slice_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] from ``prefix``, the same wherever the slice stands."""
    return mix((pre[end] - pre[start]) * _powers(len(pre))[1][start])


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and row offsets (len + 1); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    body = col.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20,
           rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` bytes of ``column`` and at most ``rows`` rows (one row at
    least), so that the work arrays of a step stay small whatever the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, min(at + rows, int(np.searchsorted(ends, done + limit, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every row (len + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    sep = IS_SEP[data]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, sep[:-1]
    before[edge] = True
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, sep[1:]
    after[edge[edge > 0] - 1] = True
    starts = np.flatnonzero(~sep & before)
    ends = np.flatnonzero(~sep & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hash(byte_prefix(data), starts, ends)


def row_of(first: np.ndarray, n: int) -> np.ndarray:
    """Row number of each of n items, given the first item of every row (len + 1)."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first)) if n else np.zeros(0, np.int64)


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which k items of one row begin, and their row."""
    n = int(first[-1])
    row = row_of(first, n)
    at = np.arange(n)
    fits = at + k <= first[row + 1] if n else np.zeros(0, bool)
    return at[fits], row[fits]


def _sliding(values: np.ndarray, w: int, op) -> np.ndarray:
    """op over every ``w`` neighbours (len - w + 1 results), by doubling."""
    out, span = values, 1
    while span < w:
        step = min(span, w - span)
        out = op(out[:-step], out[step:])
        span += step
    return out


def picks(pre: np.ndarray, first: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing over k-grams: (place, row, hash) of every gram that is the smallest (or equal to
    it) of ``w`` neighbouring grams of its row.

    ``pre``: ``prefix`` of the items of all rows, one row after the other; ``first``: first item of
    every row (len + 1).  Any k + w - 1 items of a row hold a pick, and equal stretches of that
    length hold equal picks at equal places.
    """
    n = int(first[-1])
    none = np.zeros(0, np.int64)
    if n < k + w - 1:
        return none, none, none.astype(_U)
    h = mix((pre[k:] - pre[:-k]) * _powers(n + 1)[1][:n - k + 1])
    low = _sliding(h, w, np.minimum)
    ends = np.repeat(first[1:], np.diff(first))[:len(low)]
    low = np.where(np.arange(len(low)) + (k + w - 1) <= ends, low, _U(0))
    wide = np.zeros(len(low) + 2 * (w - 1), dtype=_U)
    wide[w - 1:w - 1 + len(low)] = low
    high = _sliding(wide, w, np.maximum)          # of the windows that hold the gram
    at = np.flatnonzero((high == h) & (high > 0))
    return at, np.searchsorted(first, at, side="right") - 1, h[at]
