"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct 5-word shingles (A-Z lowered; fewer words: the whole
sequence as one; no words: empty, linked with nothing).  Two documents are linked if their sets'
Jaccard similarity reaches the threshold; a component is what links connect.

1.  One pass over the texts gives each row its set's size, a 128-bit digest, and a sketch:
    ``REGISTERS`` registers, each the minimum over the set of an exponential hash, on a scale of
    powers of ``BASE`` and truncated to a byte.  Rows of equal sets are one class from here on.
2.  Bands of ``BAND`` register values give buckets.  The first class of a bucket is paired with
    every other one: as many pairs as members.
3.  Pairs whose sizes rule the threshold out, or whose registers' joint likelihood lies far below
    its maximum at the threshold, are left out; the rest is compared on the full sets, which also
    gives how a member's set differs from the first's.
4.  Members of the same first class that lie in different components are compared by these
    differences, in blocks inside a task: only links leave it.  A group of thousands of near copies makes
    no pairs, linked or not.
5.  Pairs of a bucket that have no first class in common are looked for last: across components,
    allowed by sizes and registers, confirmed on the full sets.

At J = 0.85, 42 bands of 6 miss a pair with probability 7e-10, at 0.8 with 1e-6; two unrelated sets of
equal size share a band's bucket with probability 2e-10, so buckets hold relatives, not strangers, at any number of documents.

Null text has an empty set.  A null doc_id takes part and is the smallest id of none (component
null only if all its ids are null).  Rows repeated, or with the same doc_id, are rows of their
own; empty tables give no rows; ``keep_first`` carries all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.llm import text as T
from sortpub.llm.components import components
from sortpub.operators.position import with_position
from sortpub.session import stage

WORDS = 5
THRESHOLD = 85          # per cent
REGISTERS, BAND = 252, 6
BASE = 1.1
SHIFT = 30              # register of a hash of 1
SIGMAS = 5.0            # log-likelihood drop of SIGMAS ** 2 / 2 rules a pair out
SALT = 256              # members confirmed beside one copy of their bucket's first
PLACES = 32             # in which a bucket meets its first class
BLOCK = 1024            # members of a bucket looked at together
_ROW_BITS = 12


# -- sets and sketches -------------------------------------------------------------------

def shingle_sets(batch_text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints (52 bits) of each row, and each row's first (len + 1)."""
    data, offsets = T.column_bytes(batch_text)
    data = T.LOWER[data]
    starts, ends, first = T.word_bounds(data, offsets)
    words = T.word_hashes(data, starts, ends)
    pre = T.prefix(words)
    at, row = T.gram_starts(first, WORDS)
    h = T.slice_hash(pre, at, at + WORDS)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        whole = T.slice_hash(pre, first[short], first[short + 1]) ^ T.seeded(WORDS, 5)[n[short]]
        h, row = np.concatenate([h, whole]), np.concatenate([row, short])
    key = np.unique((row.astype(np.uint64) << np.uint64(64 - _ROW_BITS)) | (h >> np.uint64(_ROW_BITS)))
    edges = np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(64 - _ROW_BITS)
    where = np.searchsorted(key, edges[:-1])
    return key & np.uint64((1 << (64 - _ROW_BITS)) - 1), np.append(where, len(key))


def registers(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of ``REGISTERS`` bytes per set; an empty set has zeros."""
    out = np.zeros((len(first) - 1, REGISTERS), dtype=np.uint8)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    x = (sets ^ (sets >> np.uint64(29))).astype(np.uint32)
    seeds = T.seeded(2 * REGISTERS, 23).astype(np.uint32)
    least = np.empty((REGISTERS, len(full)), dtype=np.uint32)
    for i in range(REGISTERS):
        v = x ^ seeds[2 * i]
        v *= seeds[2 * i + 1] | np.uint32(1)
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        np.minimum.reduceat(v, first[full], out=least[i])
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 32)
    k = np.floor(SHIFT - np.log(h) / np.log(BASE))
    out[full] = np.clip(k, 0, 255).astype(np.uint8).T
    return out


def _digest(sets: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    total = np.zeros(len(sets) + 1, dtype=np.uint64)
    np.cumsum(T.mix(sets + np.uint64(seed)), out=total[1:])
    return (total[first[1:]] - total[first[:-1]]).astype(np.int64)


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches):
        sets, first = shingle_sets(batch.column(2))
        sk = registers(sets, first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(first).astype(np.int64)), pa.array(_digest(sets, first, 1)),
             pa.array(_digest(sets, first, 1 << 40)), pa.array([r.tobytes() for r in sk], pa.binary())],
            names=["doc_id", "x", "n", "d1", "d2", "sk"])


# -- pairs -------------------------------------------------------------------------------

def _p(u: np.ndarray) -> np.ndarray:
    return np.clip(-np.log(np.clip(1 - np.clip(u, 0, 1) * (BASE - 1) / BASE, 1e-12, 1)) / np.log(BASE), 1e-9, 1 - 1e-9)


def possible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: int) -> np.ndarray:
    """Pairs that sizes and the joint likelihood of the registers don't rule out.

    With exact set sizes the registers above, below and equal have probabilities
    p(u - vJ), p(v - uJ) and the rest; the log-likelihood is concave in J.
    """
    ok = 100 * np.minimum(na, nb) >= threshold * np.maximum(na, nb)
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def loglik(j):
        hi, lo = _p(u - v * j), _p(v - u * j)
        return more * np.log(hi) + less * np.log(lo) + same * np.log(np.clip(1 - hi - lo, 1e-9, 1))

    at = loglik(np.minimum(threshold / 100, np.minimum(u / v, v / u)))
    best = np.max([loglik(j) for j in np.linspace(0.0, threshold / 100, 18)[:-1]], axis=0)
    return ok & (best - at <= SIGMAS ** 2 / 2)


def _sk(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)


def _np(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False)


def _lined(pairs: DataFrame, facts: DataFrame, *names: str) -> DataFrame:
    """(u, v, kind, names): every pair's v with its facts (c, names), behind the facts of its u (kind 0).

    A u stands once in front of every ``SALT`` of its members, so its facts aren't joined to each pair, and a u with very many
    members is several tasks' work.
    """
    sizes = pairs.groupBy("u").agg(F.expr(f"(count(1) + {SALT} - 1) div {SALT}").alias("_parts"))
    salted = pairs.join(sizes, "u").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("_parts")).cast("int"))
    members = salted.join(facts.withColumnRenamed("c", "v"), "v").select("u", "salt", F.lit(1).alias("kind"), "v", *names)
    heads = (sizes.select("u", F.explode(F.sequence(F.lit(0), (F.col("_parts") - 1).cast("int"))).alias("salt"))
                  .join(facts.withColumnRenamed("c", "u"), "u")
                  .select("u", "salt", F.lit(0).alias("kind"), F.col("u").alias("v"), *names))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.unionByName(heads).repartition(n, "u", "salt").sortWithinPartitions("u", "salt", "kind")
                   .select("u", "v", "kind", *names))


def _likely(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (u, v) of classes that may reach the threshold: by their sizes, then by their registers."""
    size = lambda c: classes.select(F.col("c").alias(c), F.col("n").alias(f"n{c}"))
    fit = pairs.join(size("u"), "u").join(size("v"), "v").where(100 * F.least("nu", "nv") >= threshold * F.greatest("nu", "nv")).select("u", "v")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_n, head = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, n, sk = _np(batch.column(2)), _np(batch.column(3)), _sk(batch.column(4))
            front = np.maximum.accumulate(np.where(kind == 0, np.arange(len(kind)), -1))
            a, na = sk[np.maximum(front, 0)], n[np.maximum(front, 0)]
            if (front < 0).any():                           # members of a u that stands in the batch before
                a[front < 0], na[front < 0] = head, head_n
            head_n, head = na[-1], a[-1]
            keep = (kind == 1) & possible(a, sk, na, n, threshold)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["u", "v"])

    return _lined(fit, classes.select("c", "n", "sk"), "n", "sk").mapInArrow(task, "u long, v long")


COMPARED = "u long, v long, linked boolean, nu long, nv long, diff binary"


def _compare(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (u, v) on their full sets: are they linked, set sizes, and how v differs from u.

    Members (v) stream past the set of their u; a task holds one such set.  ``diff`` holds the shingles
    that are in one of the two only.
    """
    lined = _lined(pairs, texts, "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in T.chunks(batches):
            sets, first = shingle_sets(batch.column(3))
            us, vs, kinds = (_np(batch.column(i)) for i in range(3))
            out: list[list] = [[], [], [], [], [], []]
            for i in range(len(us)):
                mine = sets[first[i]:first[i + 1]]
                if kinds[i] == 0:
                    head = mine.copy()
                    continue
                diff = np.setxor1d(mine, head, assume_unique=True)
                both = (len(mine) + len(head) - len(diff)) // 2
                linked = 100 * both >= threshold * (both + len(diff))
                for col, x in zip(out, (us[i], vs[i], linked, len(head), len(mine), diff.tobytes())):
                    col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))],
                names=["u", "v", "linked", "nu", "nv", "diff"])

    return lined.mapInArrow(task, COMPARED)


def _star_links(m, i: int, j: int, c, comp, n, diffs: list[bytes], head: int, threshold: int):
    """Links between members of one first class (or of two of its blocks) that lie in different components.

    x and y both differ little from the first set p.  With the symmetric differences X and Y to p,
    |x ^ y| = |X| + |Y| - 2 |X & Y|, so the common shingles follow from the differences alone.
    One link per joined component is enough.
    """
    sets = [np.frombuffer(d, np.uint64) for d in diffs]
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1                                      # the others add nothing to any |X & Y|
    place = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], place[column[use]]
    left, right = np.flatnonzero(m == i), np.flatnonzero(m == j)
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    where = {False: np.full(len(sets), -1), True: np.full(len(sets), -1)}
    where[False][left], where[True][right] = np.arange(len(left)), np.arange(len(right))
    for a in range(0, int(shared.sum()), 2048):
        x, y = np.searchsorted(column, [a, a + 2048])
        block = np.zeros((len(sets), 2048), np.float32)
        block[row[x:y], column[x:y] - a] = 1
        both += block[left] @ block[right].T
    apart = sizes[left][:, None] + sizes[right][None, :] - 2 * both.astype(np.int64)
    common = (n[left][:, None] + n[right][None, :] - apart) // 2
    ok = (100 * common >= threshold * (common + apart)) & (comp[left][:, None] != comp[right][None, :])
    x, y = np.nonzero(ok)
    u, v = left[x], right[y]
    parent: dict[int, int] = {}

    def find(z):
        while parent.get(z, z) != z:
            z = parent[z]
        return z

    out = []
    for a, b in zip(u.tolist(), v.tolist()):
        p, q = find(int(comp[a])), find(int(comp[b]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((int(c[a]), int(c[b])))
    return out


def _blocked(rows: DataFrame, key: str) -> DataFrame:
    """Rows of groups (``key``, ``size``) in pairs of blocks (i, j) of about ``BLOCK`` members, ``_m`` the own block,
    sorted so that a pair of blocks stands together."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.withColumn("_k", F.expr(f"cast((size + {BLOCK} - 1) div {BLOCK} as int)"))
                .withColumn("_m", F.pmod(F.xxhash64("c"), F.col("_k")).cast("int"))
                .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
                .withColumn("i", F.least("_m", "_o")).withColumn("j", F.greatest("_m", "_o"))
                .repartition(parts, key, "i", "j").sortWithinPartitions(key, "i", "j"))


def _each_group(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], work) -> Iterator[pa.RecordBatch]:
    """Calls ``work`` with the table and the group starts of whole groups; keeps an open one for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not len(table):
            continue
        last = np.logical_and.reduce([(k := _np(table.column(x).combine_chunks())) == k[-1] for x in keys])
        tail = int(np.argmax(last))
        if tail:
            yield from _groups(table.slice(0, tail), keys, work)
        held = table.slice(tail)
    if held is not None and len(held):
        yield from _groups(held, keys, work)


def _groups(table: pa.Table, keys: tuple[str, ...], work) -> Iterator[pa.RecordBatch]:
    cols = [_np(table.column(x).combine_chunks()) for x in keys]
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in cols]) if len(table) > 1 else np.zeros(0, bool)
    start = np.flatnonzero(np.concatenate(([True], new)))
    pairs = work(table, list(zip(start.tolist(), np.append(start[1:], len(table)).tolist())))
    u, v = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _links_by_first(star: DataFrame, comp: DataFrame, threshold: int) -> DataFrame:
    """Links between members of the same first class, from their differences to it."""
    sizes = star.groupBy("u").agg((F.count(F.lit(1))).alias("size"))
    rows = (star.select("u", F.col("v").alias("c"), F.col("nv").alias("n"), F.col("nu").alias("head"), "diff").join(sizes, "u")
                .join(comp, "c", "left").withColumn("comp", F.coalesce("comp", "c")))
    several = rows.groupBy("u").agg(F.min("comp").alias("_a"), F.max("comp").alias("_z")).where("_a <> _z").select("u")
    lined = _blocked(rows.join(several, "u"), "u").select("u", "i", "j", "_m", "c", "comp", "n", "head", "diff")

    def work(table: pa.Table, groups: list) -> list:
        i, j, m, c, comp_, n, head = (_np(table.column(x).combine_chunks()) for x in ("i", "j", "_m", "c", "comp", "n", "head"))
        diffs = table.column("diff").to_pylist()
        return [p for a, b in groups if b - a > 1
                for p in _star_links(m[a:b], i[a], j[a], c[a:b], comp_[a:b], n[a:b], diffs[a:b], head[a], threshold)]

    return lined.mapInArrow(lambda batches: _each_group(batches, ("u", "i", "j"), work), "u long, v long")


def least_equal(threshold: int) -> int:
    """Registers that a pair at the threshold has equal, less ``SIGMAS`` deviations (any sizes that allow it)."""
    ratio = np.linspace(threshold / 100, 1, 50)
    u, v = 1 / (1 + ratio), ratio / (1 + ratio)
    same = (1 - _p(u - v * threshold / 100) - _p(v - u * threshold / 100)).min()
    return int(REGISTERS * same - SIGMAS * np.sqrt(REGISTERS * same * (1 - same)))


def _unseen_pairs(m, i: int, j: int, c, comp, n, sk, seen, firsts: list, threshold: int, floor: int) -> list:
    """Pairs of one bucket (or two of its blocks), across components, that sizes and registers allow
    and that have no first class in common.  ``seen``: compared with this bucket's first class."""
    if seen.all():
        return []
    left, right = np.flatnonzero(m == i), np.flatnonzero(m == j)
    out = []
    step = max(1, (1 << 23) // (REGISTERS * max(1, len(right))))
    for a in range(0, len(left), step):
        some = left[a:a + step]
        same = (sk[some][:, None, :] == sk[right][None, :, :]).sum(axis=2)
        ok = (same >= floor) & (comp[some][:, None] != comp[right][None, :]) & ~(seen[some][:, None] & seen[right][None, :])
        if i == j:
            ok &= some[:, None] < right[None, :]
        x, y = np.nonzero(ok)
        u, v = some[x], right[y]
        new = np.array([firsts[p].isdisjoint(firsts[q]) for p, q in zip(u, v)], bool)
        u, v = u[new], v[new]
        if len(u):
            ok = possible(sk[u], sk[v], n[u], n[v], threshold)
            out += zip(np.minimum(c[u], c[v])[ok].tolist(), np.maximum(c[u], c[v])[ok].tolist())
    return out


def _pairs_without_first(labelled: DataFrame, star: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs left inside buckets: across components, allowed by sizes and registers, and not yet
    compared with, or by way of, a common first class."""
    several = labelled.groupBy("b").agg(F.min("comp").alias("_a"), F.max("comp").alias("_z")).where("_a <> _z").select("b")
    firsts = (star.select(F.col("v").alias("c"), "u").unionByName(star.select(F.col("u").alias("c"), "u"))
                  .groupBy("c").agg(F.collect_set("u").alias("firsts")))      # a member's buckets are its bands: at most 42 and itself
    mixed = (labelled.join(several, "b").join(classes.select("c", "n", "sk"), "c").join(firsts, "c", "left")
                     .withColumn("firsts", F.coalesce("firsts", F.array().cast("array<bigint>")))
                     .withColumn("seen", F.array_contains("firsts", F.col("u"))))
    lined = _blocked(mixed, "b").select("b", "i", "j", "_m", "c", "comp", "n", "sk", "seen", "firsts")
    floor = least_equal(threshold)

    def work(table: pa.Table, groups: list) -> list:
        i, j, m, c, comp, n = (_np(table.column(x).combine_chunks()) for x in ("i", "j", "_m", "c", "comp", "n"))
        sk, seen = _sk(table.column("sk")), _np(table.column("seen").combine_chunks())
        firsts_ = [set(x) for x in table.column("firsts").to_pylist()]
        return [p for a, b in groups if b - a > 1
                for p in _unseen_pairs(m[a:b], i[a], j[a], c[a:b], comp[a:b], n[a:b], sk[a:b], seen[a:b], firsts_[a:b], threshold, floor)]

    return lined.mapInArrow(lambda batches: _each_group(batches, ("b", "i", "j"), work), "u long, v long").distinct()


# -- the operator ------------------------------------------------------------------------

def _order(doc_id: Column, x: Column) -> Column:
    """Smallest doc_id first, null last; the text's hash splits repeated doc_ids."""
    return F.struct(doc_id.isNull().alias("z"), doc_id.alias("d"), x.alias("x"))


def _classed(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, x, n, d1, d2), (classes: d1, d2, n, comp, first: the component's first row)."""
    T.small_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("x"), "text")
    rows = stage(keyed.mapInArrow(_sketch_task, "doc_id long, x long, n long, d1 long, d2 long, sk binary"), "sketches")
    grouped = rows.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min(_order(F.col("doc_id"), F.col("x"))).alias("first"), F.first("sk").alias("sk"))
    classes = stage(with_position(grouped, ["d1", "d2", "n"], "c"), "classes")

    bands = classes.select("c", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("sk", 1 + i * BAND, BAND)) for i in range(REGISTERS // BAND)])).alias("b"))
    # A bucket meets its members in as many of ``PLACES`` places as it has members in, so a hot one is several tasks' work.
    bands = bands.withColumn("t", F.pmod(F.xxhash64("c"), F.lit(PLACES)).cast("int"))
    buckets = (bands.groupBy("b").agg(F.min("c").alias("u"), F.count(F.lit(1)).alias("size"), F.bit_or(F.expr("shiftleft(1L, t)")).alias("_places"))
                    .where("size > 1"))                         # only buckets of two and more
    places = F.filter(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda t: F.expr("_places").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), t)) != 0)
    members = stage(bands.join(buckets.select("b", "u", "size", F.explode(places).alias("t")), ["b", "t"]).drop("t"), "members")
    texts = _texts(keyed, classes, members)

    pairs = stage(_likely(members.where("c <> u").select("u", F.col("c").alias("v")).distinct(), classes, threshold), "star")
    star = stage(_compare(pairs, texts, threshold), "compared")
    links = star.where("linked").select("u", "v")
    near = stage(_links_by_first(star, components(links), threshold), "near")
    links = links.unionByName(near)
    labelled = (members.where("size > 2").join(components(links), "c", "left")
                       .withColumn("comp", F.coalesce("comp", "c")).select("b", "u", "size", "c", "comp"))
    rest = stage(_pairs_without_first(stage(labelled, "labelled"), star, classes, threshold), "rest")
    links = stage(links.unionByName(_compare(rest, texts, threshold).where("linked").select("u", "v")), "links")
    comp = classes.select("d1", "d2", "n", "c", "first").join(components(links), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    firsts = comp.groupBy("comp").agg(F.min("first").alias("lead"))
    return rows.drop("sk"), comp.join(firsts, "comp").select("d1", "d2", "n", "lead")


def _texts(keyed: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(c, text): one text of every class that shares a bucket."""
    wanted = (classes.join(members.select("c").distinct(), "c", "left_semi")
                     .select("c", F.col("first.d").alias("_d"), F.col("first.x").alias("_x")))
    found = keyed.join(wanted, keyed.doc_id.eqNullSafe(F.col("_d")) & (keyed.x == F.col("_x")))
    return stage(found.select("c", "text").dropDuplicates(["c"]), "texts")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of ``docs``."""
    rows, classes = _classed(docs, threshold)
    both = rows.join(classes, ["d1", "d2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("lead.d"))
    return both.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` (its own columns) with one row of each component: the smallest doc_id's.

    Rows without words all stay.
    """
    rows, classes = _classed(docs, threshold)
    key = lambda d, x: _order(d, x)
    gone = (rows.where("n > 0").join(classes, ["d1", "d2", "n"])
                .where(key(F.col("doc_id"), F.col("x")) != F.col("lead"))
                .select(F.col("doc_id").alias("_d"), F.col("x").alias("_x")).distinct())
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_x"),
                      F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_w"))
    left = row.join(gone, row._d.eqNullSafe(gone._d) & (row._x == gone._x), "left_anti")
    once = left.where("_w").dropDuplicates(["_d", "_x"])
    return once.select("row.*").unionByName(left.where("not _w").select("row.*"))


SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sh),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {THRESHOLD} * (a.n + b.n - count(*))),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sh.doc_id, coalesce(c, sh.doc_id)) AS component_id,
       sh.doc_id <= coalesce(c, sh.doc_id) AS kept
FROM sh LEFT JOIN comp ON sh.doc_id = comp.u
"""
