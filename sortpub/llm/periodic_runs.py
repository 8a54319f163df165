"""Periodic runs inside documents by multi-scale minimizers.

A run is a maximal stretch of words with smallest period q (words q apart are identical) that is
at least ``max(MIN_WORDS, 3 * q)`` long.  Every run is found, in one pass over the texts and
without a shuffle:

* Periods below ``FIRST`` by direct lag scans: word i against word i + d for every such d.
* Longer ones by scale: P = FIRST, 2 * FIRST, ... stands for the periods P to 2 P - 1.  A scale hashes
  grams of P / 2 words and picks the least gram of every P / 2 neighbours, so a window is
  P - 1 words long.  A run of period q >= P repeats its windows q words later, with the same picks; so
  two equal picks stand q apart.  Equal picks P to 2 P - 1 apart are seeds; a seed is extended both ways
  at its lag by binary search over prefix hashes.
* A gram that itself lies in a run of a third of its length or less is no pick: it would
  pair with each of its shifts.  Not every window of a longer run can be made of such
  grams (two runs overlap in less than the sum of their periods), so nothing is lost, and an
  allowed gram recurs at most a dozen times within 2 P words.
* A stretch found at a multiple of its period has the ends of the run of its smallest period,
  which an earlier step has found: the smallest period of equal ends stays.

Extensions are compared word by word before they count, so a hash never decides a run.

Null texts are empty; a null doc_id is never rewritten by the rule of the digest; repeated rows
give equal rows; a text of any length is one row's work (memory grows with the longest text); empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.llm import text as T
from sortpub.llm.sql import crc32

MIN_WORDS = 24          # least length of a run
REPEATS = 3             # least length in periods
FIRST = 16              # periods below are scanned lag by lag
_NEVER = np.uint64((1 << 64) - 1)

RUN = "start long, length long, period long"
DIGEST = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


# -- stretches ---------------------------------------------------------------------------

def _bands(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every stretch of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lag_scan(ids: np.ndarray, row: np.ndarray, d: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches [s, e) of ``least`` words or more in which words ``d`` apart are identical."""
    if len(ids) <= d:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = _bands((ids[d:] == ids[:-d]) & (row[d:] == row[:-d]))
    e = e + d
    long = e - s >= least
    return s[long], e[long]


def _extend(pre: np.ndarray, m: np.ndarray, d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal [s, e) around place m at lag d inside rows [lo, hi), by prefix hashes.

    words[a:b] == words[a + d:b + d] if the hashes of the slices agree, shifted by base ** d.
    """
    power = T._powers(len(pre))[0]

    def same(a, b):
        return (pre[b] - pre[a]) * power[d] == pre[b + d] - pre[a + d]

    def search(room, ok):
        low, high = np.zeros(len(room), np.int64), room.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            good = ok(mid)
            low, high = np.where(good, mid, low), np.where(good, high, mid - 1)
        return low

    right = search(hi - d - m, lambda n: same(m, m + n))
    left = search(m - lo, lambda n: same(m - n, m))
    return m - left, m + right + d


def _sound(ids: np.ndarray, s: np.ndarray, e: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Do the words of [s, e) agree at lag d?  (Compared word by word, some stretches at a time.)"""
    out = np.ones(len(s), bool)
    size = e - s - d
    for part in np.array_split(np.arange(len(s)), max(1, int(size.sum()) >> 21)):
        if not len(part):
            continue
        n = size[part]
        start = np.concatenate(([0], np.cumsum(n)[:-1]))
        at = np.arange(int(n.sum())) - np.repeat(start, n) + np.repeat(s[part], n)
        wrong = ids[at] != ids[at + np.repeat(d[part], n)]
        out[part] = ~np.logical_or.reduceat(wrong, start)
    return out


class _Found:
    """Stretches (s, e, d) with the smallest period of each pair of ends."""

    def __init__(self):
        self.s = self.e = self.d = np.zeros(0, np.int64)

    def add(self, s, e, d) -> None:
        s, e, d = (np.concatenate(x) for x in ((self.s, s), (self.e, e), (self.d, d)))
        order = np.lexsort((d, e, s))
        s, e, d = s[order], e[order], d[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        self.s, self.e, self.d = s[new], e[new], d[new]


def _picks(gram: np.ndarray, allowed: np.ndarray, w: int) -> np.ndarray:
    """Places of the allowed grams that are the least (or equal to it) of some ``w`` neighbouring grams."""
    h = np.where(allowed, np.minimum(gram, _NEVER - np.uint64(1)), _NEVER)
    if len(h) < w:
        return np.zeros(0, np.int64)
    low = T._sliding(h, w, np.minimum)
    wide = np.zeros(len(low) + 2 * (w - 1), dtype=np.uint64)
    wide[w - 1:w - 1 + len(low)] = np.where(low == _NEVER, np.uint64(0), low)
    return np.flatnonzero(allowed & (T._sliding(wide, w, np.maximum) == h))


def _scale(ids: np.ndarray, first: np.ndarray, p: int, found: _Found) -> None:
    """Runs of period p to 2 p - 1, added to ``found`` (which holds those of shorter periods)."""
    k = w = p // 2
    n = len(ids)
    row = T.row_of(first, n)
    pre = T.prefix(T.mix(ids.copy()))
    gram = T.mix((pre[k:] - pre[:-k]) * T._powers(n + 1)[1][:n - k + 1])
    inside = np.arange(len(gram)) + k <= first[row[:len(gram)] + 1]
    dense = (REPEATS * found.d <= k) & (found.e - found.s >= k)
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, found.s[dense], 1)
    np.add.at(cover, found.e[dense] - k + 1, -1)
    at = _picks(gram, inside & (np.cumsum(cover)[:len(gram)] == 0), w)
    at = at[np.lexsort((at, gram[at], row[at]))]
    h, r = gram[at], row[at]
    seeds_m, seeds_d, step = [], [], 1
    while step < len(at):
        gap = at[step:] - at[:-step]
        near = (h[step:] == h[:-step]) & (r[step:] == r[:-step]) & (gap < 2 * p)
        if not near.any():
            break
        good = near & (gap >= p)
        seeds_m.append(at[:-step][good])
        seeds_d.append(gap[good])
        step += 1
    if not seeds_m:
        return
    m, d = np.concatenate(seeds_m), np.concatenate(seeds_d)
    s, e = _extend(pre, m, d, first[row[m]], first[row[m] + 1])
    long = e - s >= REPEATS * d
    s, e, d, m = s[long], e[long], d[long], m[long]
    _, one = np.unique(np.stack([s, e, d]), axis=1, return_index=True)
    s, e, d, m = s[one], e[one], d[one], m[one]
    sound = _sound(ids, s, e, d)
    for x in np.flatnonzero(~sound):            # equal hashes of unequal words: that lag word by word
        a, b = first[row[m[x]]], first[row[m[x]] + 1]
        more_s, more_e = lag_scan(ids[a:b], row[a:b], int(d[x]), REPEATS * int(d[x]))
        found.add(more_s + a, more_e + a, np.full(len(more_s), d[x]))
    found.add(s[sound], e[sound], d[sound])


def runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run, in order of start and period.

    ``ids``: an integer per word, all rows one after the other; ``first``: first word of every row
    (len + 1).
    """
    found = _Found()
    row = T.row_of(first, len(ids))
    for d in range(1, FIRST):
        s, e = lag_scan(ids, row, d, REPEATS * d)
        found.add(s, e, np.full(len(s), d, np.int64))
    p, size = FIRST, np.diff(first)
    while len(size) and size.max() >= REPEATS * p:
        # Rows too short for this scale are left out of its arrays.
        rows = np.flatnonzero(size >= REPEATS * p)
        sub = np.concatenate(([0], np.cumsum(size[rows])))
        shift = first[rows] - sub[:-1]
        near = np.repeat(shift, size[rows])
        local = _Found()
        which = np.searchsorted(first, found.s, side="right") - 1
        here = np.searchsorted(rows, which)
        mine = (here < len(rows)) & (rows[np.minimum(here, len(rows) - 1)] == which)
        move = shift[here[mine]]
        local.add(found.s[mine] - move, found.e[mine] - move, found.d[mine])
        _scale(ids[np.arange(sub[-1]) + near], sub, p, local)
        back = near[local.s]
        found.add(local.s + back, local.e + back, local.d)
        p *= 2
    long = (found.e - found.s >= np.maximum(MIN_WORDS, REPEATS * found.d))
    s, e, d = found.s[long], found.e[long], found.d[long]
    order = np.lexsort((d, s))
    return s[order], e[order], d[order]


# -- words of a batch --------------------------------------------------------------------

def _rewritten(first: np.ndarray, doc_ids: list) -> np.ndarray:
    """For every word the word that stands there: the digest's rule repeats a block to the end of some documents."""
    at = np.arange(int(first[-1]))
    for i, doc_id in enumerate(doc_ids):
        n = int(first[i + 1] - first[i])
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = np.arange(a, n)
            at[first[i] + a:first[i + 1]] = first[i] + a + (x - a) % p
    return at


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of every row joined by one space, and each row's first byte (len + 1; a space ends every word)."""
    kept = np.flatnonzero(keep)
    a, size = starts[kept], ends[kept] - starts[kept] + 1
    edge = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(int(edge[-1])) + np.repeat(a - edge[:-1], size)
    out = data[np.minimum(at, len(data) - 1)] if len(at) else np.zeros(0, np.uint8)
    out[edge[1:] - 1] = 0x20
    return out, edge[np.searchsorted(kept, first)]


def _best(runs_: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    return min(runs_, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def _each(batches: Iterator[pa.RecordBatch], rewrite: bool):
    """(doc_ids, data, starts, ends, first, (s, e, d)) of every slice of the batches."""
    for batch in T.chunks(batches):
        doc_ids = batch.column(0).to_pylist()
        data, offsets = T.column_bytes(batch.column(1))
        starts, ends, first = T.word_bounds(data, offsets)
        ids = T.word_hashes(data, starts, ends)
        if rewrite:
            at = _rewritten(first, doc_ids)
            starts, ends, ids = starts[at], ends[at], ids[at]
        yield doc_ids, data, starts, ends, first, runs(ids, first)


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, data, starts, ends, first, (s, e, d) in _each(batches, rewrite=True):
        gone = np.zeros(len(starts) + 1, np.int32)
        np.add.at(gone, s + d, 1)
        np.add.at(gone, e, -1)
        out, edge = _joined(data, starts, ends, first, np.cumsum(gone)[:-1] == 0)
        body = out.tobytes()
        cut = np.searchsorted(s, first)
        rows = []
        for i, doc_id in enumerate(doc_ids):
            mine = [(int(x - first[i]), int(y - x), int(z)) for x, y, z in zip(*(v[cut[i]:cut[i + 1]] for v in (s, e, d)))]
            best = _best(mine) if mine else (None, None, None)
            listed = "".join(f"{x},{y},{z}\n" for x, y, z in mine)
            rows.append((doc_id, len(mine), *best, 1000 * best[1] // best[2] if mine else None,
                         hashlib.sha256(listed.encode()).hexdigest(),
                         hashlib.sha256(body[edge[i]:max(edge[i], edge[i + 1] - 1)]).hexdigest()))
        types = [pa.int64()] * 6 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in DIGEST.split(", ")])


def _runs_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, _, _, _, first, (s, e, d) in _each(batches, rewrite=False):
        row = np.searchsorted(first, s, side="right") - 1
        ids = pa.array(doc_ids, pa.int64()).take(pa.array(row))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(x.astype(np.int64)) for x in (s - first[row], e - s, d))],
                                         names=["doc_id", "start", "length", "period"])


def _collapse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, data, starts, ends, first, (s, e, d) in _each(batches, rewrite=False):
        gone = np.zeros(len(starts) + 1, np.int32)
        np.add.at(gone, s + d, 1)
        np.add.at(gone, e, -1)
        dropped = np.cumsum(gone)[:-1] > 0
        out, edge = _joined(data, starts, ends, first, ~dropped)
        body = out.tobytes()
        texts = [body[edge[i]:max(edge[i], edge[i + 1] - 1)].decode() for i in range(len(doc_ids))]
        total = np.concatenate(([0], np.cumsum(dropped)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(texts, pa.string()), pa.array((total[first[1:]] - total[first[:-1]]).astype(np.int64))],
            names=["doc_id", "collapsed", "n_dropped"])


# -- the operator ------------------------------------------------------------------------

def _rows(docs: DataFrame) -> DataFrame:
    T.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run of every text, in words."""
    return _rows(docs).mapInArrow(_runs_task, f"doc_id long, {RUN}")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, collapsed, n_dropped): every text with one period left of each run, words joined by one space."""
    return _rows(docs).mapInArrow(_collapse_task, "doc_id long, collapsed string, n_dropped long")


def run_digest(docs: DataFrame) -> DataFrame:
    """The digest of every document, some of whose texts the digest's rule has made periodic before."""
    return _rows(docs).mapInArrow(_digest_task, DIGEST)


SQL = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w0, {crc32('CAST(doc_id AS VARCHAR)')} AS h FROM documents),
cut AS (
  SELECT doc_id, w0, h, len(w0) AS n, CASE WHEN len(w0) > 0 THEN (h // 10) % len(w0) END AS a FROM docs),
block AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut),
w AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w0[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w0 END AS w FROM block),
x AS (SELECT doc_id, n, unnest(w) AS g, unnest(range(0, n)) AS i FROM w),
lag_ AS (
  SELECT u.doc_id, v.i - u.i AS d, u.i, u.i - row_number() OVER (PARTITION BY u.doc_id, v.i - u.i ORDER BY u.i) AS k
  FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.g = v.g AND v.i > u.i AND {REPEATS} * (v.i - u.i) <= u.n),
stretch AS (
  SELECT doc_id, d, min(i) AS s, count(*) + d AS l FROM lag_ GROUP BY doc_id, d, k HAVING count(*) + d >= greatest({MIN_WORDS}, {REPEATS} * d)),
r AS (SELECT doc_id, s, l, min(d) AS q FROM stretch GROUP BY doc_id, s, l),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM r),
kept AS (SELECT x.doc_id, string_agg(g, ' ' ORDER BY x.i) AS t FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY x.doc_id),
best AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         first(struct_pack(s := s, l := l, q := q) ORDER BY l / q DESC, s, q) AS b
  FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
