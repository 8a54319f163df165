"""Substring dedup over words by repeated-phrase automata.

Every word that a window of ``WINDOW`` consecutive words covers is removed, if the window's word sequence also starts in a
document with a smaller doc_id; windows are judged on the input.

1.  Winnowing picks phrases of ``PHRASE`` words so that every window holds one, at the same place in equal
    windows; documents whose picked phrases may stand in other documents go on (``recurrence``), in shards of about
    ``SHARD_BYTES`` of text.
2.  The phrases' texts are confirmed: those of documents with different doc_ids (one exchange; a shard sends a phrase
    once, however many of its documents hold it) go back to the shards they came from.
3.  Each shard compiles its confirmed phrases into an Aho-Corasick automaton whose letters are words, and streams
    its documents whole through it.  All places come from the automaton's hits, whether picked there or not.
    A window belongs to the hit of smallest hash in it (the leftmost of several); windows of one hit form a segment.
4.  Segments go to the part that their phrase names.  There every window takes the smallest doc_id of all
    equal windows; a larger doc_id loses it.  Of equal segments of a shard the smallest doc_id's stand for all
    (the others are removed at once).

Why no window is missed: the smallest phrase of a window is picked wherever that window stands.  If it stands in documents of
two doc_ids, the phrase is confirmed and in the automata of their shards, and no other hit in the window is smaller; so equal windows
belong to equal phrases at equal places.  A document without a candidate phrase holds no such window and isn't streamed;
copies of a text are stood for by the first.

A phrase with more than ``HOT`` documents would make one large part; its windows are exchanged by
their own hashes instead (a window's smallest doc_id is a minimum), so no part is large.  Its places come from the automata too.

Null text has no words.  A null doc_id comes last (nulls are no smaller than each other).  Rows with the
same doc_id are never removed for one another; with the same text too they are one document, judged
alike.  Texts shorter than ``WINDOW`` words lose nothing; empty tables give no rows; only
doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.llm import recurrence as R
from sortpub.llm import text as T
from sortpub.operators.position import with_position
from sortpub.session import stage

WINDOW = 50
PHRASE = 8
SPAN = WINDOW - PHRASE + 1
LEFT = WINDOW - PHRASE
HOT = 20_000
SHARD_SEGMENTS = 20_000
SHARD_BYTES = 4 << 20
HELD_PHRASES = 100_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _words(column: pa.Array):
    data, offsets = T.column_bytes(column)
    starts, ends, first = T.word_bounds(data, offsets)
    return data, starts, ends, first, T.prefix(T.word_hashes(data, starts, ends))


def _prints(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    _, _, _, first, pre = _words(column)
    return T.picks(pre, first, PHRASE, SPAN)


def _windows(pre: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, o, hash) of the windows that begin o words before each place and stay in [lo, hi)."""
    o = np.arange(LEFT + 1)
    begin = at[:, None] - o
    i, o = np.nonzero((begin >= lo[:, None]) & (begin + WINDOW <= hi[:, None]))
    begin = at[i] - o
    return i, o, T.slice_hash(pre, begin, begin + WINDOW)


# -- segments ------------------------------------------------------------------------------

def _pack(r, q, pos, left, bodies: list[bytes]) -> bytes:
    sizes = np.array([len(b) for b in bodies], np.int64)
    head = np.concatenate([r, q, pos, left, sizes]).astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(bodies)).tobytes() + head.tobytes() + b"".join(bodies))


def _unpack(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    head = np.frombuffer(body, np.int64, 5 * n, 8).reshape(5, n)
    ends = 8 + 40 * n + np.cumsum(head[4])
    return head[:4], [body[e - k:e] for e, k in zip(ends.tolist(), head[4].tolist())]


def _into_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the documents' shards: about ``SHARD_BYTES`` of a task's texts, one document at least."""
    shard, size = R.task_id() << 32, 0
    for batch in T.chunks(batches, limit=SHARD_BYTES // 4):
        if size > SHARD_BYTES:
            shard, size = shard + 1, 0
        size += batch.column("text").nbytes
        yield batch.append_column("shard", pa.array([shard] * batch.num_rows, pa.int64()))


def _joined(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> Callable[[int, int], bytes]:
    """Words a to b - 1 joined by one space: the bytes themselves, where only single spaces stand between."""
    if not len(starts):
        return lambda a, b: b""
    data = np.frombuffer(raw, np.uint8)
    odd = np.concatenate(([0], np.cumsum((starts[1:] - ends[:-1] != 1) | (data[np.minimum(ends[:-1], len(data) - 1)] != 0x20))))

    def words(a: int, b: int) -> bytes:
        body = raw[starts[a]:ends[b - 1]]
        return body if odd[b - 1] == odd[a] else b" ".join(_WORD.findall(body))

    return words


def _phrases_task(n_prints: int) -> Callable:
    """Documents -> (phrase, shard, least and greatest doc_id, documents) of the candidate phrases."""
    def flush(held: dict) -> pa.RecordBatch:
        keys, facts = list(held), list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([k[1] for k in keys], pa.binary()), pa.array([k[0] for k in keys], pa.int64()),
             *(pa.array([f[i] for f in facts], pa.int64()) for i in range(3))], names=["phrase", "shard", "lo", "hi", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list[int]] = {}
        for batch in T.chunks(batches):
            data, starts, ends, first, pre = _words(batch.column("text"))
            at, row, h = T.picks(pre, first, PHRASE, SPAN)
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            words = _joined(data.tobytes(), starts, ends)
            shards, qs = batch.column("shard").to_pylist(), batch.column("d1").to_pylist()
            for i, keys in enumerate(batch.column("keys").to_pylist()):
                c = slice(edge[i], edge[i + 1])
                use, _ = R.chosen(keys, h[c], n_prints)
                q = qs[i]
                for phrase in {words(x, x + PHRASE) for x in at[c][use].tolist()}:
                    fact = held.setdefault((shards[i], phrase), [q, q, 0])
                    fact[0], fact[1], fact[2] = min(fact[0], q), max(fact[1], q), fact[2] + 1
            if len(held) > HELD_PHRASES:
                yield flush(held)
                held = {}
        if held:
            yield flush(held)

    return task


# -- a shard -------------------------------------------------------------------------------

def occurrences(phrases: list[bytes], words: list[bytes], first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(place, phrase number) of every occurrence of the phrases among the words, inside one row; ``first``: first word of every
    row (len + 1)."""
    number: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, phrase in enumerate(phrases):
        automaton.add_word(tuple(number.setdefault(w, len(number) + 1) for w in phrase.split(b" ")), k)
    at: list[int] = []
    which: list[int] = []
    if number:
        automaton.make_automaton()
        for a, b in zip(first, first[1:]):
            for end, k in automaton.iter(tuple(number.get(w, 0) for w in words[a:b])):
                at.append(a + end + 1 - PHRASE), which.append(k)
    return np.array(at, np.int64), np.array(which, np.int64)


def _leftmost(values: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of every ``w`` neighbours and its first place (len - w + 1 results), by doubling."""
    low, at, span = values, np.arange(len(values)), 1
    while span < w:
        step = min(span, w - span)
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        span += step
    return low, at


def _locate(n_parts: int, hot: int) -> Callable:
    """A shard's documents and confirmed phrases -> segments (kind 0), windows of hot phrases (kind 1), spans removed
    at once (kind 2)."""
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("blob", pa.binary())])

    def shard(docs: pa.Table, confirmed: pa.Table) -> pa.Table:
        known = dict(zip(confirmed.column("phrase").to_pylist(), confirmed.column("n").to_pylist()))
        if not known or not len(docs):
            return schema.empty_table()
        data, starts, ends, first, pre = _words(docs.column("text"))
        raw = data.tobytes()
        phrases = list(known)
        hits, which = occurrences(phrases, [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], first.tolist())
        value, heat = np.full(len(starts), NONE), np.zeros(len(starts), bool)
        value[hits] = np.minimum(T.slice_hash(pre, hits, hits + PHRASE), NONE - np.uint64(1))
        heat[hits] = np.array([known[p] > hot for p in phrases], bool)[which]

        # Windows, each with its hit.
        row = T.row_of(first, len(starts))
        begin, _ = T.gram_starts(first, WINDOW)
        if not len(begin):
            return schema.empty_table()
        low, anchor = _leftmost(value, SPAN)
        begin = begin[low[begin] < NONE]
        anchor = anchor[begin]
        edge = R.starts_of(anchor)
        at, lo = anchor[edge], begin[edge]
        hi = (begin[np.append(edge[1:], len(begin)) - 1] if len(begin) else begin) + WINDOW
        r_of, q_of = docs.column("r").to_numpy(), docs.column("d1").to_numpy()
        kinds, parts, blobs, spans = [], [], [], []

        cold = np.flatnonzero(~heat[at])
        words = _joined(raw, starts, ends)
        bodies = [words(a, b) for a, b in zip(lo[cold].tolist(), hi[cold].tolist())]
        r, q, pos = r_of[row[at[cold]]], q_of[row[at[cold]]], at[cold] - first[row[at[cold]]]
        left, right = (at - lo)[cold], (hi - at)[cold]
        part = R.parts(T.mix(value[at[cold]]), n_parts)
        least: dict[tuple[bytes, int], int] = {}
        same = list(zip(bodies, left.tolist()))
        for key, v in zip(same, q.tolist()):
            if v < least.get(key, v + 1):
                least[key] = v
        later = np.array([v > least[key] for key, v in zip(same, q.tolist())], bool)
        spans.append((r[later], (pos - left)[later], (pos + right)[later]))
        keep = np.flatnonzero(~later)
        keep = keep[np.argsort(part[keep], kind="stable")]
        start = R.starts_of(part[keep])
        for a, b in zip(start, np.append(start, len(keep))[1:]):
            c = keep[a:b]
            kinds.append(0), parts.append(int(part[c[0]])), blobs.append(_pack(r[c], q[c], pos[c], left[c], [bodies[i] for i in c]))

        warm = begin[heat[anchor]]
        if len(warm):
            doc = row[warm]
            ids, places = r_of[doc], warm - first[doc]
            p, packed, gone = R.pack_windows(T.slice_hash(pre, warm, warm + WINDOW), q_of[doc], ids, places, n_parts, within=False)
            kinds.extend([1] * len(p)), parts.extend(p), blobs.extend(packed)
            spans.append((ids[gone], places[gone], places[gone] + WINDOW))
        merged = R.merge_spans(*(np.concatenate([x[i] for x in spans]).astype(np.int64) for i in range(3)))
        if len(merged[0]):
            kinds.append(2), parts.append(int(merged[0][0]) % n_parts), blobs.append(b"".join(x.tobytes() for x in merged))
        return pa.table([pa.array(kinds, pa.int32()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    return shard


# -- a part --------------------------------------------------------------------------------

def scan_part(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One part's segments -> spans (r, s, e) in words."""
    heads, bodies = [], []
    for blob in blobs:
        head, more = _unpack(blob)
        heads.append(head), bodies.extend(more)
    r, q, pos, left = np.concatenate(heads, axis=1)
    # Equal segments are looked at once.
    number: dict[tuple[bytes, int], int] = {}
    of = np.array([number.setdefault((b, k), len(number)) for b, k in zip(bodies, left.tolist())], np.int64)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, of, q)

    # Windows around the occurrences.
    column = pa.array([b for b, _ in number], pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1)
    data = np.frombuffer(column.buffers()[2], np.uint8)[:offsets[-1]]
    starts, ends, first = T.word_bounds(data, offsets)
    pre = T.prefix(T.word_hashes(data, starts, ends))
    lefts = np.array([k for _, k in number], np.int64)
    i, o, h = _windows(pre, first[:-1] + lefts, first[:-1], first[1:])
    order = np.argsort(h, kind="stable")
    begin = R.starts_of(h[order])
    smallest = np.empty(len(h), np.int64)
    if len(h):
        smallest[order] = np.repeat(np.minimum.reduceat(least[i[order]], begin), np.diff(np.append(begin, len(h))))
    # Each segment's windows stand together (np.nonzero), so its places take them as one slice.
    edge = np.searchsorted(i, np.arange(len(number) + 1))
    count = np.diff(edge)[of]
    entry = np.repeat(np.arange(len(of)), count)
    window = np.repeat(edge[of], count) + np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    gone = smallest[window] < q[entry]
    entry, back = entry[gone], o[window[gone]]
    at = R.starts_of(entry)
    low, high = back[at], (back[np.append(at[1:], len(entry)) - 1] if len(entry) else back)
    entry = entry[at]
    return R.merge_spans(r[entry], pos[entry] - high, pos[entry] - low + WINDOW)


def _span_table(r, s, e) -> pa.Table:
    return pa.table({"r": pa.array(r, pa.int64()), "s": pa.array(s, pa.int64()), "e": pa.array(e, pa.int64())})


def _part_task(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One part of what the shards sent: segments to scan, windows to compare, or spans as they are."""
    kind, blobs = key[0].as_py(), table.column("blob").to_pylist()
    if kind == 0:
        return _span_table(*scan_part(blobs))
    if kind == 1:
        r, s = R.later_windows(blobs, within=False)
        return _span_table(*R.merge_spans(r, s, s + WINDOW))
    return _span_table(*np.concatenate([np.frombuffer(b, np.int64).reshape(3, -1) for b in blobs], axis=1))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and spans -> kept words joined by one space, removed words."""
    for batch in batches:
        kept, gone = [], []
        for text, spans in zip(batch.column(2), batch.column(3).to_pylist()):
            words = _WORD.findall((text.as_py() or "").encode())
            pairs = np.array([(x["s"], x["e"]) for x in spans or []], np.int64).reshape(-1, 2)
            _, s, e = R.merge_spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
            left, at = [], 0
            for a, b in zip(s.tolist(), e.tolist()):
                left += words[at:a]
                at = b
            left += words[at:]
            kept.append(b" ".join(left).decode()), gone.append(len(words) - len(left))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.string()), pa.array(gone, pa.int64())],
                                         names=["d1", "d2", "kept", "n_removed"])


def drop_phrases(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by a space; null where none is removed), sha
    (of all words so joined): a row per row of ``docs``."""
    rows = R.keyed(docs)
    joined = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    n_words = F.when(joined == "", F.lit(0)).otherwise(F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit(""))) + 1)
    narrow, firsts, total = R.first_texts(rows, [n_words.cast("long").alias("n_words"), F.sha2(joined, 256).alias("sha")])
    places = total // 6 // (SPAN + 1) * 2                # about six bytes a word
    n_prints, n_parts = max(8, places // R.PART_PRINTS), max(8, places // SHARD_SEGMENTS)
    marks = with_position(R.recurring(firsts, _prints, n_prints, hot, per_document=True), R.DOC, "r")
    held = stage(firsts.join(marks, R.DOC).dropDuplicates(R.DOC).select("r", *R.DOC, "text", "keys")
                       .mapInArrow(_into_shards, "r long, d1 long, d2 long, text string, keys array<binary>, shard long"), "candidates")
    phrases = stage(held.select("shard", "d1", "text", "keys")
                        .mapInArrow(_phrases_task(n_prints), "phrase binary, shard long, lo long, hi long, n long"), "phrases")
    confirmed = (phrases.groupBy("phrase").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
                        .where("lo < hi").select("phrase", "n"))
    told = phrases.select("shard", "phrase").join(confirmed, "phrase")
    sent = (held.select("shard", "r", "d1", "text").groupBy("shard").cogroup(told.groupBy("shard"))
                .applyInArrow(_locate(n_parts, hot), "kind int, part int, blob binary"))
    spans = sent.groupBy("kind", "part").applyInArrow(_part_task, "r long, s long, e long")
    by_text = spans.groupBy("r").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    cut = (held.join(by_text, "r").select(*R.DOC, "text", "spans")
               .mapInArrow(_cut, "d1 long, d2 long, kept string, n_removed long"))
    whole = F.col("copy") & (F.col("n_words") >= WINDOW)
    return narrow.join(cut, R.DOC, "left").select(
        "doc_id", "n_words", "sha", F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"))


def phrase_digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The contract's columns."""
    sha = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2(F.col("kept"), 256))
    return drop_phrases(docs, hot).select("doc_id", "n_words", "n_removed", sha.alias("kept_sha256"))


SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1:s + {WINDOW}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {WINDOW - 1}, 0))) AS s FROM w)),
first AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT win.doc_id, s + k AS n FROM win JOIN first ON win.h = first.h AND first.d < win.doc_id, range({WINDOW}) r(k)),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS n FROM w),
sums AS (
  SELECT e.doc_id, count(*) AS n_words, count(g.n) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY e.n) FILTER (WHERE g.n IS NULL), '')) AS kept_sha256
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.n = g.n GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN sums s USING (doc_id)
"""
