"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised (lower case, runs of ASCII other than letters and digits
become one space; letters of other scripts stay).  An item of m characters may differ by
``e = m * BUDGET`` edits.  It is cut into e // 2 + 1 pairs of pieces: in any text within that
distance one pair has one error at most, and one of its pieces none.  One Aho-Corasick automaton
finds all pieces of all items; a piece whose pair stands there with at most one error fixes where
the item would begin; beginnings within e of each other are verified once, by Myers' bit-parallel
distance of the item to the best substring there.

Items under ``MIN_CHARS`` normalised characters occur with errors by chance, so they have no error budget: they are found
where they stand exactly, between spaces (word boundaries) of the normalised text.  ``leak_pairs`` tells all of them;
``drop_leaks`` lets a document go for such an item only if the item has ``DROP_WORDS`` words or more, since an answer
such as "yes" is no leak.

Equal items are first counted, and items of equal normalised text share one entry of the automaton.  They are staged as
a table with one folder per shard of about ``SHARD_CHARS`` characters.  The shards are taken one after the other: the driver
and a task hold one shard, and each pass over the documents is written before the next shard is read, so
neither grows with the benchmark.

Null and empty texts match nothing, nor do items without a letter or digit; repeated rows and items are judged each; a
null doc_id or item_id stays null; empty tables give no rows; ``leak_pairs`` reads doc_id and text, item_id and
text, ``drop_leaks`` carries all columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.llm.text import small_batches
from sortpub.session import scratch_path, stage

BUDGET = 0.10
MIN_CHARS = 24          # below it items are matched exactly
DROP_WORDS = 3          # words of such an item that lets a document go
SHARD_CHARS = 4_000_000

# Normalisation of ASCII bytes: capitals are lowered before, what is neither letter nor digit
# becomes a space; bytes of other characters stay.
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def normalise(text: str | None) -> str:
    data = _SPACED[np.frombuffer((text or "").lower().encode("utf-8", "replace"), dtype=np.uint8)]
    space = data == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    return data[keep].tobytes().decode("utf-8").strip(" ")


def pieces(item: str, errors: int) -> list[tuple[int, str, int, str]]:
    """At least errors + 1 pieces in pairs: (place of the pair, pair, place of the piece, piece).

    Of ``errors // 2 + 1`` pairs one holds at most one error, and of its two pieces one holds
    none: an exact piece is found, its pair is checked for one error, then the whole item.
    """
    n = errors // 2 + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        mid = (a + b) // 2
        out += [(a, item[a:b], x, item[x:y]) for x, y in ((a, mid), (mid, b)) if y > x]
    return out


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_distance(peq: dict[str, int], m: int, text: str) -> int:
    """Myers: least edit distance of the pattern to any substring of ``text``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best


def one_error(half: str, text: str) -> bool:
    """Does some prefix of ``text`` differ from ``half`` by one edit at most?"""
    n = len(half)
    i = 0
    for a, b in zip(half, text):
        if a != b:
            break
        i += 1
    if i >= n - 1:
        return True
    rest = half[i + 1:]
    return rest == text[i + 1:n] or half[i:] == text[i + 1:n + 1] or rest == text[i:n - 1]


class Item(NamedTuple):
    """One normalised text and what carries it."""

    norm: str
    errors: int
    masks: dict[str, int]
    ids: list[tuple[int | None, int]]       # item_id and how often it has this text

    @property
    def drops(self) -> bool:
        return len(self.norm) >= MIN_CHARS or self.norm.count(" ") + 1 >= DROP_WORDS


class Matcher:
    """The items of one shard; ``match`` gives {item number: distance} within the budget."""

    def __init__(self, items: list[tuple[int | None, str, int]], budget: float):
        """``items``: (item_id, text, times)."""
        ids: dict[str, list[tuple[int | None, int]]] = {}
        for item_id, text, times in items:
            norm = normalise(text)
            if norm:
                ids.setdefault(norm, []).append((item_id, times))
        self.items = []
        where: dict[str, list] = {}
        for k, (norm, carriers) in enumerate(ids.items()):
            short = len(norm) < MIN_CHARS
            errors = 0 if short else int(len(norm) * budget)
            self.items.append(Item(norm, errors, {} if short else masks(norm), carriers))
            if short:
                where.setdefault(f" {norm} ", []).append((k, None, "", ""))
                continue
            for a, pair, at, piece in pieces(norm, errors):
                # The pair's other half: before the piece (reversed) or behind it.
                before, behind = pair[:at - a][::-1], pair[at - a + len(piece):]
                where.setdefault(piece, []).append((k, at, before, behind))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def _begins(self, text: str, found: dict[int, int]) -> dict[int, list[int]]:
        """Where items would begin, by the pieces whose pair stands there with one error at most; short
        items, whose piece is all of them, go straight into ``found``."""
        spots: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            begin = end + 1 - size
            for k, at, before, behind in places:
                if at is None:
                    found[k] = 0
                elif (one_error(before, text[max(0, begin - len(before) - 1):begin][::-1]) if before
                        else one_error(behind, text[end + 1:end + 2 + len(behind)])):
                    spots.setdefault(k, []).append(begin - at)
        return spots

    def match(self, text: str) -> dict[int, int]:
        """``text``: normalised.  A space is put around it, so that its first and last word have boundaries; no item
        begins or ends with one, so distances stay."""
        if self.empty or not text:
            return {}
        found: dict[int, int] = {}
        text = f" {text} "
        for k, begins in self._begins(text, found).items():
            norm, errors, peq, _ = self.items[k]
            begins.sort()
            best, i = errors + 1, 0
            while i < len(begins) and best:
                j = i
                while j + 1 < len(begins) and begins[j + 1] - begins[j] <= errors:
                    j += 1
                window = text[max(0, begins[i] - errors):begins[j] + len(norm) + errors]
                best = 0 if norm in window else min(best, best_distance(peq, len(norm), window))
                i = j + 1
            if best <= errors:
                found[k] = best
        return found

    def leaked(self, text: str) -> bool:
        return any(self.items[k].drops for k in self.match(text))


class Shards:
    """The items, counted and staged by shard; ``read`` brings one shard to the driver."""

    def __init__(self, items: DataFrame, limit: int):
        spark = items.sparkSession
        self.spark, self.path = spark, scratch_path(spark, "items")
        counted = stage(items.where("text is not null").groupBy(F.col("item_id").cast("long").alias("item_id"), "text")
                             .agg(F.count(F.lit(1)).alias("times")), "counted_items")
        chars = counted.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        self.n = -(-chars // limit)
        self.table = counted
        if self.n > 1:
            shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n)).cast("int")
            (counted.withColumn("shard", shard).repartition("shard").write.partitionBy("shard").parquet(self.path))
            self.table = spark.read.schema("item_id long, text string, times long, shard int").parquet(self.path)

    def read(self, k: int) -> list[tuple[int | None, str, int]]:
        rows = self.table.where(F.col("shard") == k) if self.n > 1 else self.table
        return [tuple(r) for r in rows.select("item_id", "text", "times").toLocalIterator()]


def leak_pairs(docs: DataFrame, items: DataFrame, budget: float = BUDGET, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, item_id, distance: a row per document row and item found in it."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def passed(shard: list[tuple[int | None, str, int]]) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shard, budget)
            for batch in batches:
                out = [(doc, item_id, d, times) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                       for k, d in sorted(matcher.match(normalise(text.as_py())).items())
                       for item_id, times in matcher.items[k].ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                    names=["doc_id", "item_id", "distance", "times"])

        return slim.mapInArrow(task, "doc_id long, item_id long, distance int, times long")

    shards = Shards(items, shard_chars)
    if shards.n <= 1:
        found = passed(shards.read(0))
    else:
        found = reduce(DataFrame.unionByName, (stage(passed(shards.read(k)), f"leaks_{k}") for k in range(shards.n)))
    each = F.sequence(F.lit(1).cast("long"), "times")
    return found.select("doc_id", "item_id", "distance", F.explode(each).alias("_i")).drop("_i")


def drop_leaks(docs: DataFrame, items: DataFrame, budget: float = BUDGET, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``docs`` (its own columns) without the rows in which an item is found."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    schema = docs.schema

    def passed(docs: DataFrame, shard: list[tuple[int | None, str, int]]) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shard, budget)
            for batch in batches:
                clean = [not matcher.leaked(normalise(text.as_py())) for text in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return docs.mapInArrow(task, schema)

    shards = Shards(items, shard_chars)
    for k in range(shards.n):
        docs = passed(docs, shards.read(k))
        if k + 1 < shards.n:
            docs = stage(docs, f"clean_{k}")
    return docs
