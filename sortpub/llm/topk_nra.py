"""Exact top-k inner products by aggregation without random access.

Vectors become integers (floor of 64 times each component).  Rows stand in blocks; each dimension of a
block is a list sorted by value, read from the top where the query's weight is positive and from the
bottom where it is negative.  The lists are read in steps (``DEPTHS``), all to the same depth:

* a step brings each list's next entries (row, value), and nothing else is ever read of a row; for each
  query and row a partial sum takes up what was read;
* an unread entry is at most the value at which its list stands now, and at least the list's last value:
  partial sum and frontier give a row's upper and lower bound;
* the k-th best score known so far for a query (from blocks before, at first from lower bounds) is
  the bar; pairs whose upper bound lies below it are outsiders, and reading stops for them;
* when the lists are at their end, the partial sums of the pairs left are their scores.

Before that, the greatest and smallest values of a block bound every score in it: queries whose bar is above
leave the block unread.  The first step is a matrix product over a block of rows and a block of queries; later
ones go by the pairs left.  Ties with the bar stay in.  A task streams the row blocks of one lane past one group of
``GROUP_QUERIES`` queries (blocks of ``BLOCK_QUERIES`` inside) and keeps k rows a query; a row block travels once to
each group, as integers of the least width that holds all values.

Null vectors and vectors with null or non-finite components take no part, nor do rows without
vec_id; scores must fit 64 bits; a vec_id counts once: of several vectors the one that is
smallest (component by component, a shorter one before its extensions) is taken; a shorter vector
counts as zero in the dimensions it lacks; ties go to the smaller vec_id; empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortpub.session import stage

K = 20
SCALE = 64
QUERY_STEP = 20
BLOCK_ROWS = 2048
BLOCK_QUERIES = 1024
GROUP_QUERIES = 8192
LANE_BLOCKS = 32
MERGE = 256
DEPTHS = (0.75, 0.9, 1.0)
PAIRS = 16_384          # pairs whose sums are taken up at a time


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors as arrays of long."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    ok = table.where(x.isNotNull() & F.col("vec_id").isNotNull()).where(~bad)
    whole = F.transform(x, lambda e: F.floor(F.lit(SCALE) * e.cast("double")).cast("long"))
    return ok.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dim), dtype=kind)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def _blocks(dim: int, rows: int, kind: str):
    """Vectors -> blocks (ids, values) as blobs."""
    def flush(held: list) -> pa.RecordBatch:
        ids, v = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], names=["ids", "v"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(rows - n, batch.num_rows - at))
                held.append((part.column(0).to_numpy(), _matrix(part.column(1), dim, kind)))
                at, n = at + part.num_rows, n + part.num_rows
                if n == rows:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return task


class Lists:
    """A block of rows as one sorted list a dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids = ids
        self.order = np.argsort(x, axis=0, kind="stable")           # list place -> row, smallest value first
        self.values = np.take_along_axis(x, self.order, axis=0)
        self.most = float(np.abs(self.values[[0, -1]].astype(np.float64)).max(initial=0))

    def _spread(self, a: int, b: int, values: np.ndarray, kind) -> np.ndarray:
        """List places [a, b), row by row; rows outside hold 0."""
        out = np.zeros(self.values.shape, kind)
        np.put_along_axis(out, self.order[a:b], values, axis=0)
        return out

    def read(self, a: int, b: int, kind) -> np.ndarray:
        """The entries from depth ``a`` to ``b``, by row: read from the top, then read from the bottom."""
        n = len(self.values)
        return np.concatenate([self._spread(n - b, n - a, self.values[n - b:n - a], kind),
                               self._spread(a, b, self.values[a:b], kind)], axis=1)

    def unread(self, depth: int, top: np.ndarray, bottom: np.ndarray, kind) -> np.ndarray:
        """The entries behind ``depth`` by row, as if they were ``top`` (``bottom``) of their list."""
        n = len(self.values)
        return np.concatenate([self._spread(0, n - depth, top, kind), self._spread(depth, n, bottom, kind)], axis=1)

    def frontier(self, depth: int, kind) -> np.ndarray:
        """Unread entries at the values the lists stand at: bounds from above, weight by weight."""
        return self.unread(depth, self.values[len(self.values) - depth], self.values[depth - 1], kind)

    def last(self, depth: int, kind) -> np.ndarray:
        """Unread entries at the lists' last values: bounds from below."""
        return self.unread(depth, self.values[0], self.values[-1], kind)


class Search:
    """One block of queries and the best k rows of each so far."""

    def __init__(self, ids: np.ndarray, w: np.ndarray, k: int):
        w = w.astype(np.int64)
        self.ids, self.k = ids, k
        self.w = np.concatenate([np.maximum(w, 0), np.minimum(w, 0)], axis=1)     # for lists from the top, from the bottom
        self.q = np.zeros(0, np.int64)                     # best rows: query number, vec_id, score
        self.v = np.zeros(0, np.int64)
        self.s = np.zeros(0, np.int64)
        self.bar = np.zeros(len(ids), np.int64)            # k-th best score, where k rows are known
        self.known = np.zeros(len(ids), bool)

    def block(self, lists: Lists) -> None:
        n = len(lists.ids)
        size = lists.most * float(np.abs(self.w).max(initial=0)) * 2 * self.w.shape[1]
        kind = np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else np.int64
        ends = np.concatenate([lists.values[-1], lists.values[0]]).astype(kind)
        asked = np.flatnonzero(~self.known | (self.w.astype(kind) @ ends >= self.bar))
        if not len(asked):
            return
        w, known = self.w[asked].astype(kind), self.known[asked]
        own = lists.ids[:, None] == self.ids[asked][None, :]
        depths = sorted({min(n, max(1, math.ceil(d * n))) for d in DEPTHS})
        # First step: every pair of the block.
        depth = depths[0]
        total = lists.read(0, depth, kind) @ w.T
        bar = self.bar[asked].astype(kind)
        open_ = ~known                                     # no bar yet: the k-th best lower bound is one
        if open_.any() and n > self.k:
            low = total[:, open_] + lists.last(depth, kind) @ w[open_].T
            low[own[:, open_]] = -np.inf if kind != np.int64 else np.iinfo(np.int64).min
            bar[open_], open_ = np.partition(low, n - self.k, axis=0)[n - self.k], np.zeros(len(asked), bool)
        inside = (total + lists.frontier(depth, kind) @ w.T >= bar) | open_
        i, q = np.nonzero(inside & ~own)
        sums = total[i, q]
        # Later steps: the pairs left take up what the lists bring.
        for to in depths[1:]:
            brought = lists.read(depth, to, kind)
            ahead = lists.frontier(to, kind) if to < n else None
            stays = np.ones(len(i), bool)
            for a in range(0, len(i), PAIRS):
                c = slice(a, a + PAIRS)
                weights = w[q[c]]
                sums[c] += np.einsum("ij,ij->i", brought[i[c]], weights)
                if ahead is not None:
                    stays[c] = sums[c] + np.einsum("ij,ij->i", ahead[i[c]], weights) >= bar[q[c]]
            stays |= open_[q]
            i, q, sums, depth = i[stays], q[stays], sums[stays], to
        self._keep(asked[q], lists.ids[i], sums.astype(np.int64))

    def _keep(self, q: np.ndarray, v: np.ndarray, s: np.ndarray) -> None:
        q, v, s = np.concatenate([self.q, q]), np.concatenate([self.v, v]), np.concatenate([self.s, s])
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        first = np.searchsorted(q, np.arange(len(self.ids) + 1))
        rank = np.arange(len(q)) - first[q]
        keep = rank < self.k
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.bar[full], self.known[full] = s[first[full] + self.k - 1], True
        self.q, self.v, self.s = q[keep], v[keep], s[keep]

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.q], pa.int64()), pa.array(self.v, pa.int64()), pa.array(self.s, pa.int64())],
                                          names=["query_id", "vec_id", "score"])


def _search_task(dim: int, k: int, kind: str, block: int):
    """Rows (row, ids, v) in order: a group of queries (row 0), then the row blocks of a lane."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: list[Search] = []
        for batch in batches:
            for row, ids, v in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                v = np.frombuffer(v.as_buffer(), kind).reshape(len(ids), dim)
                if row:
                    lists = Lists(ids, v)
                    for search in searches:
                        search.block(lists)
                else:
                    yield from (s.result() for s in searches)
                    searches = [Search(ids[a:a + block], v[a:a + block], k) for a in range(0, len(ids), block)]
        yield from (s.result() for s in searches)

    return task


def _width(low: int, high: int) -> str:
    """The narrowest integers that hold all values."""
    return next(t for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def top_k(table: DataFrame, k: int = K, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of every query row."""
    vectors = stage(integer_vectors(table), "vectors")
    none = F.lit(0)
    n, dim, low, high, asked = vectors.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), none), F.coalesce(F.min(F.array_min("v")), none),
        F.coalesce(F.max(F.array_max("v")), none), F.count_if(F.col("vec_id") % step == 0)).first()
    dim, kind = max(dim, 1), _width(min(low, 0), max(high, 0))
    groups = max(1, -(-asked // GROUP_QUERIES))
    lanes = max(4, -(-n // (BLOCK_ROWS * LANE_BLOCKS)))
    shape = "ids binary, v binary"
    # Groups of about GROUP_QUERIES queries by hash; each goes to every lane.
    queries = (vectors.where(F.col("vec_id") % step == 0).withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")))

    def gather(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("vec_id").to_numpy().astype(np.int64)
        v = _matrix(group.column("v").combine_chunks(), dim, kind)
        return pa.table({"qb": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "v": pa.array([v.tobytes()], pa.binary())})

    heads = (queries.groupBy("qb").applyInArrow(gather, f"qb int, {shape}")
                    .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))))
    rows = (vectors.mapInArrow(_blocks(dim, BLOCK_ROWS, kind), shape).withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
                   .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    met = (heads.select("qb", "lane", F.lit(0).alias("row"), "ids", "v")
                .unionByName(rows.select("qb", "lane", F.lit(1).alias("row"), "ids", "v"))
                .repartition(groups * lanes, "qb", "lane").sortWithinPartitions("qb", "lane", "row")
                .select("row", "ids", "v"))
    best = met.mapInArrow(_search_task(dim, k, kind, BLOCK_QUERIES), "query_id long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    while lanes > MERGE:                                     # at most k * MERGE rows meet at a time
        lanes = -(-lanes // MERGE)
        some = Window.partitionBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(lanes))).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
