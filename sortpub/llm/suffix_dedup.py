"""Substring dedup over bytes by a distributed, common-prefix-aware merge sort of suffixes.

Every byte that a ``LENGTH``-byte string covers which also starts earlier (smaller doc_id, or the same document
and an earlier start) is removed; strings are judged on the input.

1.  A sparse set of suffixes is enough: winnowing picks places so that every ``LENGTH`` bytes hold
    one, at the same place in equal strings (``recurrence``).  Only suffixes whose first ``GRAM``
    bytes recur go on.
2.  Each task sorts its suffixes: the bytes from the place on, then the bytes before it, backwards.
    Of equal ones the first stands for all (the others are removed at once).  Sorted runs are
    exchanged front-coded: each suffix as the length of the prefix it shares with the one before
    it, and the rest.
3.  A part merges its runs with a loser tree whose nodes keep the prefix length shared with the
    last winner.  The longer shared prefix wins without a look at the bytes; at a tie the
    comparison starts behind the known prefix.  The merge hands on each suffix's common prefix.
4.  Suffixes that share ``GRAM`` bytes stand together.  Equal ones have one earliest place.  Of
    different ones, each string of ``LENGTH`` bytes around the place is looked up among the others;
    the earliest keeps it.

A gram with more than ``HOT`` places would make one large group; its strings are exchanged by
their own hashes instead (a string's earliest place is a minimum), so no part is large.

Null text is empty text.  A null doc_id comes last.  Rows with the same doc_id and text are one
document and judged alike; with the same doc_id and other texts they are ordered by the texts'
hashes.  Texts shorter than ``LENGTH`` lose nothing; empty tables give no rows; only doc_id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.llm import recurrence as R
from sortpub.llm import text as T
from sortpub.operators.position import with_position
from sortpub.session import stage

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1                 # winnowing window
LEFT = LENGTH - GRAM                     # bytes before a place that a string can reach
KEY = LENGTH + LEFT                      # bytes of a suffix that are compared
WIDTH = KEY + 2                          # and its two lengths
HOT = 20_000
PART_SUFFIXES = 60_000
RUN_BYTES = 16 << 20


def _prints(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = T.column_bytes(column)
    return T.picks(T.byte_prefix(data), offsets, GRAM, SPAN)


# -- suffixes and runs -----------------------------------------------------------------------

def suffix_rows(data: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """One row of WIDTH bytes per place: LENGTH bytes on, LEFT bytes back, both lengths."""
    right = np.minimum(hi - at, LENGTH)
    left = np.minimum(at - lo, LEFT)
    out = np.zeros((len(at), WIDTH), dtype=np.uint8)
    on, back = np.arange(LENGTH), np.arange(1, LEFT + 1)
    out[:, :LENGTH] = np.where(on < right[:, None], data[np.minimum(at[:, None] + on, len(data) - 1)], 0)
    out[:, LENGTH:KEY] = np.where(back <= left[:, None], data[np.maximum(at[:, None] - back, 0)], 0)
    out[:, KEY], out[:, KEY + 1] = right, left
    return out


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row before it (0 for the first)."""
    out = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)
    return out


def front_code(rows: np.ndarray, r: np.ndarray, pos: np.ndarray) -> bytes:
    """A sorted run: shared prefix lengths, the bytes behind them, documents and places."""
    shared = shared_prefixes(rows)
    rest = rows[np.arange(WIDTH) >= shared[:, None]]
    body = np.uint32(len(rows)).tobytes() + shared.tobytes() + r.astype(np.int64).tobytes() + pos.astype(np.int64).tobytes() + rest.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


class Run:
    """Reads a front-coded run suffix by suffix."""

    def __init__(self, blob: bytes):
        body = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(body, np.uint32, 1)[0])
        self.shared = body[4:4 + n]
        self.r = np.frombuffer(body, np.int64, n, 4 + n)
        self.pos = np.frombuffer(body, np.int64, n, 4 + 9 * n)
        self.rest, self.at, self.next, self.n, self.key = body, 4 + 17 * n, 0, n, b""

    def read(self) -> bytes | None:
        """The next suffix, or None; ``shared[next - 1]`` is its prefix shared with the last."""
        i = self.next
        if i == self.n:
            return None
        k = self.shared[i]
        to = self.at + WIDTH - k
        self.key = self.key[:k] + self.rest[self.at:to]
        self.at, self.next = to, i + 1
        return self.key


class LoserTree:
    """Merges runs; every node keeps its loser and the prefix length it shares with the winner."""

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.keys: list[bytes | None] = [run.read() for run in runs] + [None] * (self.size - len(runs))
        self.loser = [0] * self.size
        self.known = [0] * self.size
        self.winner, self.shared = self._play(1) if self.size > 1 else (0, 0)

    def _beats(self, a: int, b: int, known: int) -> tuple[bool, int]:
        """(a's suffix comes before b's or equals it, prefix they share), from ``known`` on."""
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None, 0
        differ = int.from_bytes(x[known:], "big") ^ int.from_bytes(y[known:], "big")
        if not differ:
            return a < b, WIDTH
        at = WIDTH - (differ.bit_length() + 7) // 8
        return x[at] < y[at], at

    def _play(self, node: int) -> tuple[int, int]:
        """First round below ``node``: (winner, 0: nothing is known of it yet)."""
        if node >= self.size:
            return node - self.size, 0
        a, b = self._play(2 * node)[0], self._play(2 * node + 1)[0]
        first, shared = self._beats(a, b, 0)
        self.loser[node], self.known[node] = (b, shared) if first else (a, shared)
        return (a, 0) if first else (b, 0)

    def __iter__(self) -> Iterator[tuple[int, int, bytes, int]]:
        """(run, its suffix number, suffix, prefix shared with the suffix before)."""
        keys, loser, known, runs, size = self.keys, self.loser, self.known, self.runs, self.size
        while True:
            w = self.winner
            key = keys[w]
            if key is None:
                return
            run = runs[w]
            yield w, run.next - 1, key, self.shared
            keys[w] = run.read()
            # A run's next suffix shares with the last winner what it shares with its own last.
            have = run.shared[run.next - 1] if keys[w] is not None else -1
            node = (w + size) >> 1
            while node:
                other = known[node] if keys[loser[node]] is not None else -1
                if other > have:
                    w, loser[node] = loser[node], w
                    have, known[node] = other, have
                elif other == have and have >= 0:
                    first, shared = self._beats(w, loser[node], have)
                    if first:
                        known[node] = shared
                    else:
                        w, loser[node] = loser[node], w
                        known[node] = shared
                node >>= 1
            self.winner, self.shared = w, have


# -- what the merged order shows ---------------------------------------------------------------

def _string_keys(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) of the LENGTH-byte string that begins o bytes before each row's place, o = 0 .. LEFT;
    strings of different groups or o have different hashes."""
    line = np.concatenate([rows[:, LENGTH:KEY][:, ::-1], rows[:, :LENGTH]], axis=1)
    h = _string_hashes(line)
    o = np.arange(LEFT + 1)
    valid = (o <= rows[:, KEY + 1][:, None]) & (LENGTH - o <= rows[:, KEY][:, None])
    return T.mix(h + T.seeded(LEFT + 1, 71)[o][None, :] + (group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]), valid


def _string_hashes(line: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH bytes that begin LEFT - o, for o = 0 .. LEFT."""
    powers, inverse = T._powers(KEY + 1)
    pre = np.zeros((len(line), KEY + 1), dtype=np.uint64)
    np.cumsum(T._BYTE[line] * powers[:KEY], axis=1, out=pre[:, 1:])
    begin = LEFT - np.arange(LEFT + 1)
    return T.mix((pre[:, begin + LENGTH] - pre[:, begin]) * inverse[begin])


def later_strings(rows: np.ndarray, group: np.ndarray, r: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans (r, s, e) of the strings that an earlier different suffix of the group also holds."""
    order = np.lexsort((pos, r))
    rows, group, r, pos = rows[order], group[order], r[order], pos[order]
    h, valid = _string_keys(rows, group)
    i, o = np.nonzero(valid)
    h = h[i, o]
    order = np.lexsort((i, h))
    first = np.zeros(len(h), bool)
    first[R.starts_of(h[order])] = True
    later = np.zeros(len(h), bool)
    later[order] = ~first
    i, o = i[later], o[later]
    if not len(i):
        return r[:0], pos[:0], pos[:0]
    at = R.starts_of(i)                       # np.nonzero gives each row's o in order
    low, high = o[at], o[np.append(at[1:], len(i)) - 1]
    i = i[at]
    return r[i], pos[i] - high, pos[i] - low + LENGTH


def merge_part(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One part's runs -> spans (r, s, e) to remove."""
    runs = [Run(b) for b in blobs]
    spans: list[tuple] = []
    group: list[tuple[bytes, int, int]] = []          # different suffixes of one gram: (key, r, pos)
    block: list[tuple[bytes, int, int, int]] = []
    same: list[tuple[int, int]] = []                  # places of equal suffixes
    last = b""

    def end_class():
        if same:
            same.sort()
            group.append((last, *same[0]))
            left, right = last[KEY + 1], last[KEY]
            if left + right >= LENGTH:
                spans.extend((r, pos - left, pos + right) for r, pos in same[1:])
            same.clear()

    def end_group():
        if len(group) > 1:
            g = len(block)
            block.extend((k, r, p, g) for k, r, p in group)
        group.clear()

    def end_block():
        if block:
            rows = np.frombuffer(b"".join(x[0] for x in block), np.uint8).reshape(-1, WIDTH)
            got = later_strings(rows, np.array([x[3] for x in block]), np.array([x[1] for x in block], np.int64), np.array([x[2] for x in block], np.int64))
            spans.extend(zip(*(x.tolist() for x in got)))
            block.clear()

    for w, i, key, shared in LoserTree(runs):
        if shared < WIDTH:
            end_class()
            if shared < GRAM:
                end_group()
                if len(block) > 4_000:
                    end_block()
            last = key
        same.append((int(runs[w].r[i]), int(runs[w].pos[i])))
    end_class()
    end_group()
    end_block()
    r, s, e = (np.array([x[i] for x in spans], np.int64) for i in range(3))
    return R.merge_spans(r, s, e)


def _runs_task(n_prints: int, n_parts: int, n_windows: int):
    """Documents -> runs (kind 0), windows of hot grams (kind 1), spans removed at once (kind 2)."""
    def flush(held: list) -> Iterator[pa.RecordBatch]:
        rows, part, r, pos = (np.concatenate([x[i] for x in held]) for i in range(4))
        hr, hs, hh = (np.concatenate([x[i] for x in held]) for i in (4, 5, 6))
        spans = []
        out: tuple[list, list, list] = ([], [], [])
        order = np.lexsort((pos, r))
        order = order[np.argsort(np.ascontiguousarray(rows[order]).view(f"S{WIDTH}").ravel(), kind="stable")]
        rows, part, r, pos = rows[order], part[order], r[order], pos[order]
        again = shared_prefixes(rows) == WIDTH
        whole = again & (rows[:, KEY].astype(int) + rows[:, KEY + 1] >= LENGTH)
        spans.append((r[whole], pos[whole] - rows[whole, KEY + 1], pos[whole] + rows[whole, KEY]))
        rows, part, r, pos = rows[~again], part[~again], r[~again], pos[~again]
        order = np.argsort(part, kind="stable")
        rows, part, r, pos = rows[order], part[order], r[order], pos[order]
        start = R.starts_of(part)
        for a, b in zip(start, np.append(start, len(part))[1:]):
            out[0].append(0), out[1].append(int(part[a])), out[2].append(front_code(rows[a:b], r[a:b], pos[a:b]))
        if len(hh):
            p, blobs, later = R.pack_windows(hh, hr, hr, hs, n_windows, within=True)
            out[0].extend([1] * len(p)), out[1].extend(p), out[2].extend(blobs)
            spans.append((hr[later], hs[later], hs[later] + LENGTH))
        merged = R.merge_spans(*(np.concatenate([x[i] for x in spans]).astype(np.int64) for i in range(3)))
        out[0].append(2), out[1].append(R.task_id() % n_parts), out[2].append(b"".join(x.tobytes() for x in merged))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())],
                                         names=["kind", "part", "blob"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in T.chunks(batches):
            data, offsets = T.column_bytes(batch.column(1))
            at, row, h = T.picks(T.byte_prefix(data), offsets, GRAM, SPAN)
            use, hot = np.zeros(len(at), bool), np.zeros(len(at), bool)
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i, keys in enumerate(batch.column(2).to_pylist()):
                c = slice(edge[i], edge[i + 1])
                use[c], hot[c] = R.chosen(keys, h[c], n_prints)
            r = batch.column(0).to_numpy()
            at, row, h, hot = at[use], row[use], h[use], hot[use]
            rows = suffix_rows(data, at, offsets[row], offsets[row + 1]) if len(at) else np.zeros((0, WIDTH), np.uint8)
            begin = at - offsets[row]
            hr, hs, hh = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for c in np.array_split(np.flatnonzero(hot), max(1, int(hot.sum()) // 2_000)):
                if len(c):
                    w, valid = _string_keys(rows[c], h[c])
                    i, o = np.nonzero(valid)
                    hr.append(r[row[c]][i]), hs.append(begin[c][i] - o), hh.append(w[i, o])
            cold = ~hot
            held.append((rows[cold], R.parts(T.mix(h[cold]), n_parts), r[row[cold]], begin[cold], *map(np.concatenate, (hr, hs, hh))))
            size += int(cold.sum()) * WIDTH + 24 * len(held[-1][6])
            if size > RUN_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return task


def _span_table(r: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Table:
    return pa.table({"r": pa.array(r, pa.int64()), "s": pa.array(s, pa.int64()), "e": pa.array(e, pa.int64())})


def _part_task(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One part of what the tasks sent: runs to merge, windows to compare, or spans as they are."""
    kind, blobs = key[0].as_py(), table.column("blob").to_pylist()
    if kind == 0:
        return _span_table(*merge_part(blobs))
    if kind == 1:
        r, s = R.later_windows(blobs, within=True)
        return _span_table(*R.merge_spans(r, s, s + LENGTH))
    return _span_table(*np.concatenate([np.frombuffer(b, np.int64).reshape(3, -1) for b in blobs], axis=1))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and spans -> kept bytes, removed bytes, removed runs."""
    for batch in batches:
        kept, gone, runs = [], [], []
        for text, spans in zip(batch.column(2), batch.column(3).to_pylist()):
            data = (text.as_py() or "").encode()
            pairs = np.array([(x["s"], x["e"]) for x in spans or []], np.int64).reshape(-1, 2)
            _, s, e = R.merge_spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
            parts, at = [], 0
            for a, b in zip(s.tolist(), e.tolist()):
                parts.append(data[at:a])
                at = b
            parts.append(data[at:])
            kept.append(b"".join(parts)), gone.append(len(data) - len(kept[-1])), runs.append(len(s))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64())],
                                         names=["d1", "d2", "kept", "n_removed", "n_spans"])


def repeated_spans(texts: DataFrame, total_bytes: int, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(candidates: r, d1, d2, text), (spans: r, s, e) of documents with different texts (d1, d2, text)."""
    places = 2 * total_bytes // (SPAN + 1)
    n_prints = max(8, places // R.PART_PRINTS)
    n_parts = max(8, places // PART_SUFFIXES)
    marks = with_position(R.recurring(texts, _prints, n_prints, hot), R.DOC, "r")
    held = stage(texts.join(marks, R.DOC).dropDuplicates(R.DOC).select("r", *R.DOC, "text", "keys"), "candidates")
    sent = held.select("r", "text", "keys").mapInArrow(_runs_task(n_prints, n_parts, n_parts), "kind int, part int, blob binary")
    spans = sent.groupBy("kind", "part").applyInArrow(_part_task, "r long, s long, e long")
    return held.drop("keys"), spans


def drop_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes, null where the text stays whole), sha (of
    the whole text): a row per row of ``docs``."""
    rows = R.keyed(docs)
    narrow, firsts, total = R.first_texts(rows, [F.sha2(F.col("text").cast("binary"), 256).alias("sha")])
    texts, spans = repeated_spans(firsts, total, hot)
    by_text = spans.groupBy("r").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    cut = (texts.join(by_text, "r").select(*R.DOC, "text", "spans")
                .mapInArrow(_cut, "d1 long, d2 long, kept binary, n_removed long, n_spans long"))
    whole = F.col("copy") & (F.col("n_bytes") >= LENGTH)
    out = narrow.join(cut, R.DOC, "left")
    return out.select(
        "doc_id", "n_bytes", "sha", F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"))


def suffix_digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The contract's columns."""
    sha = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2(F.col("kept"), 256))
    return drop_repeats(docs, hot).select("doc_id", "n_bytes", "n_removed", "n_spans", sha.alias("kept_sha256"))


SQL = f"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
win AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, {2 * LENGTH})) AS h
  FROM (SELECT doc_id, x, unnest(range(0, greatest(n - {LENGTH - 1}, 0))) AS s FROM b)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
runs AS (
  SELECT doc_id, s, s - coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), s - {LENGTH + 1}) > {LENGTH} AS new FROM later),
spans AS (
  SELECT doc_id, min(s) AS s, max(s) + {LENGTH} AS e
  FROM (SELECT doc_id, s, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM runs) GROUP BY doc_id, g),
cuts AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans),
sums AS (
  SELECT c.doc_id, sum(e - c.s) AS gone, count(*) AS n, max(e) AS last,
         string_agg(substr(x, 2 * before + 1, 2 * (c.s - before)), '' ORDER BY c.s) AS head
  FROM cuts c JOIN b USING (doc_id) GROUP BY c.doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(s.n, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN sums s USING (doc_id)
"""
