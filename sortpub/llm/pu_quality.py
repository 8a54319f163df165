"""Text quality by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; everything else is unlabelled web text, read without
any label.  Labels of quality 0 are never used.

1.  One pass turns every text into ``FEATURES``: shares of kinds of bytes and words, repetition of
    words, word pairs and triples and lines, and lengths.  The rows are staged with doc_id; texts are not read again.
2.  A logistic discriminator of one half of the positives against all text orders the documents.
    The other half gives the class prior: the share of all text above a threshold over the share of
    positives above it, at the threshold where that share plus ``DEVIATIONS`` standard errors is least
    (no set of documents can hold less than the prior's part of the positives' mass).
3.  The classifier minimises the non-negative unbiased risk of the logistic loss l,

        prior * E_pos[l(z)] + max(0, E_all[l(-z)] - prior * E_pos[l(-z)]) + ridge,

    with z linear in the features.  Since l(z) - l(-z) = -z, this is the greater of two smooth convex
    functions (the unbiased risk; its positive part alone).  The minimum is that of a mixture of the two: of the unbiased risk
    alone if its negative part is not below zero there, else of the mixture that brings that part to zero,
    found by secants.  Every risk is an expectation over all documents: Newton steps whose sums
    tasks add up over the staged features; only the sums reach the driver.

Only the positives are a sample: at most ``SAMPLE_ROWS`` labelled documents, by hash of doc_id.  doc_id, lang,
source and labels are no inputs of a score.

Null and empty texts have the features of an empty text and are scored; a null doc_id is scored and
counts as not held out; repeated rows score alike, and a positive doc_id with several texts counts
once; without positives all scores are ``NO_POSITIVES``; empty tables give no rows; other columns are
ignored by the scores and carried by ``drop_poor``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.llm import text as T
from sortpub.session import stage

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
RIDGE = 1.0             # over the square root of the number of positives
NO_POSITIVES = 0.5
CLIP = 6.0              # standard deviations a feature may stand from the mean
DEVIATIONS = 2.0        # of the prior's bound
LEAST_ABOVE = 0.5       # of the positives stand above a threshold that gives the prior
STEPS = 25              # Newton steps at most for one mixture
TOLERANCE = 1e-5
CLOSE = 2e-3            # to zero, for the negative part of the risk
SECANTS = 25
BINS = 2_000            # of the discriminator's scores
UNITS = 1 << 20         # sums are added as whole numbers of this part, so their order does not matter

# Kinds of ASCII bytes.
_PUNCTUATION = b".,;:'\"?()-"
_KINDS = ("lower", "upper", "digit", "punctuation", "bang", "symbol", "space", "line", "high")

FEATURES = ("lower", "upper", "digit", "punctuation", "bang", "symbol", "space", "line", "high",
            "caps_words", "symbol_words", "plain_words", "title_words", "ended_words", "long_words",
            "same_as_last", "distinct_words", "distinct_pairs", "distinct_triples", "distinct_lines",
            "word_bytes", "words_per_line", "log_words", "log_bytes")


def _kinds() -> np.ndarray:
    kind = np.full(256, _KINDS.index("symbol"), np.uint8)
    kind[0x80:] = _KINDS.index("high")
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                        ("punctuation", _PUNCTUATION), ("bang", b"!"), ("space", (9, 11, 12, 13, 32)), ("line", (10,))):
        kind[list(chars)] = _KINDS.index(name)
    return kind


_KIND = _kinds()


# -- features ----------------------------------------------------------------------------

def _distinct(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct values of each row (hashes cut to 44 bits beside the row's number)."""
    key = np.unique((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    return np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=rows)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    data, offsets = T.column_bytes(texts)
    rows, size = len(texts), np.diff(offsets)
    kind = _KIND[data]
    part = lambda a, b: np.divide(a, np.maximum(b, 1), dtype=np.float64)
    total = {}
    for i, name in enumerate(_KINDS):
        total[name] = np.concatenate(([0], np.cumsum(kind == i)))
    of = lambda name, a, b: total[name][b] - total[name][a]
    out = {name: part(of(name, offsets[:-1], offsets[1:]), size) for name in _KINDS}

    starts, ends, first = T.word_bounds(data, offsets)
    n = np.diff(first)
    row = T.row_of(first, len(starts))
    share = lambda flag: part(np.bincount(row[flag], minlength=rows), n)
    upper, lower, high = (of(k, starts, ends) for k in ("upper", "lower", "high"))
    odd = of("symbol", starts, ends) + of("bang", starts, ends)
    out["caps_words"] = share((upper > 1) & (lower == 0))
    out["symbol_words"] = share(odd > 0)
    out["plain_words"] = share(upper + lower + high == ends - starts)
    out["title_words"] = share((kind[starts] == _KINDS.index("upper")) & (lower + high > 0)) if len(starts) else share(odd > 0)
    out["ended_words"] = share(np.isin(data[ends - 1], list(b".?!"))) if len(starts) else share(odd > 0)
    out["long_words"] = share(ends - starts > 20)
    ids = T.word_hashes(data, starts, ends)
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (row[1:] == row[:-1])
    out["same_as_last"] = share(again)
    pre = T.prefix(ids)
    for k, name in enumerate(("distinct_words", "distinct_pairs", "distinct_triples"), 1):
        at, mine = T.gram_starts(first, k)
        out[name] = np.where(n >= k, part(_distinct(T.slice_hash(pre, at, at + k), mine, rows), n - k + 1), 1.0)

    breaks = np.flatnonzero(data == 10)
    a = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    a = a[a < len(data)]
    b = np.minimum(np.append(a[1:], len(data)), len(data))
    b = b - ((b > a) & (data[b - 1] == 10)) if len(a) else b
    full = b > a
    mine = np.searchsorted(offsets, a[full], side="right") - 1
    lines = np.bincount(mine, minlength=rows)
    hashes = T.slice_hash(T.byte_prefix(data), a[full], b[full])
    out["distinct_lines"] = np.where(lines > 0, part(_distinct(hashes, mine, rows), lines), 1.0)
    out["word_bytes"] = part(np.bincount(row, weights=ends - starts, minlength=rows), n)
    out["words_per_line"] = np.log1p(part(n, lines))
    out["log_words"], out["log_bytes"] = np.log1p(n), np.log1p(size)
    return np.stack([out[name] for name in FEATURES], axis=1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def feature_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x: the features as packed floats), staged."""
    T.small_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            x = features(batch.column(2)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["doc_id", "held_out", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return stage(rows.mapInArrow(task, "doc_id long, held_out boolean, x binary"), "features")


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)


# -- sums over all documents ---------------------------------------------------------------

def _sums(rows: DataFrame, one, size: int) -> np.ndarray:
    """Sum of ``one(features)`` (``size`` numbers) over all rows; partial sums in the tasks, whole numbers of 1 / UNITS."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += one(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(np.rint(total * UNITS).astype(np.int64))], names=["k", "v"])

    got = rows.select("x").mapInArrow(task, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in got:
        out[r["k"]] = r["v"] / UNITS
    return out


class Scale:
    """Features -> (1, square-rooted shares and the rest, standardised and clipped)."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        self.mean, self.deviation = mean, deviation

    @staticmethod
    def bent(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(x, 0))], axis=1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self.bent(x) - self.mean) / self.deviation, -CLIP, CLIP)
        return np.concatenate([np.ones((len(z), 1)), z], axis=1)

    @classmethod
    def of(cls, rows: DataFrame) -> tuple["Scale", int]:
        k = 2 * len(FEATURES)

        def one(x):
            b = cls.bent(x)
            return np.concatenate([[len(x)], b.sum(axis=0), (b * b).sum(axis=0)])

        total = _sums(rows, one, 2 * k + 1)
        n = max(1.0, total[0])
        mean = total[1:k + 1] / n
        spread = np.sqrt(np.maximum(total[k + 1:] / n - mean ** 2, 0))
        return cls(mean, np.where(spread > 1e-4, spread, 1.0)), int(total[0])


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _all_sums(rows: DataFrame, scale: Scale, w: np.ndarray, n: int) -> tuple[float, np.ndarray, np.ndarray]:
    """E_all[l(-z)], its gradient and its Hessian at ``w``."""
    k = len(w)
    upper = np.triu_indices(k)

    def one(x):
        f = scale(x)
        z = f @ w
        p = _sigmoid(z)
        return np.concatenate([[_loss(-z).sum()], p @ f, ((f * (p * (1 - p))[:, None]).T @ f)[upper]])

    total = _sums(rows, one, 1 + k + len(upper[0])) / n
    hess = np.zeros((k, k))
    hess[upper] = total[1 + k:]
    return total[0], total[1:1 + k], hess + np.triu(hess, 1).T


def _minimise(rows: DataFrame, scale: Scale, n: int, pos: np.ndarray, w: np.ndarray, own: float, shift: float, all_: float) -> tuple[np.ndarray, float]:
    """Least ``own * E_pos[l(z)] - shift * E_pos[z] + all_ * E_all[l(-z)] + ridge / 2 * |w| ** 2``, by damped Newton steps.

    Returns w and E_all[l(-z)] there.
    """
    ridge = np.full(len(w), RIDGE / np.sqrt(len(pos)))
    ridge[0] /= 100

    def value(w, seen):
        z = pos @ w
        return own * _loss(z).mean() - shift * z.mean() + all_ * seen + (ridge * w * w).sum() / 2

    seen, grad, hess = _all_sums(rows, scale, w, n)
    now = value(w, seen)
    for _ in range(STEPS):
        p = _sigmoid(-(pos @ w))
        g = -own * (p @ pos) / len(pos) - shift * pos.mean(axis=0) + all_ * grad + ridge * w
        h = own * ((pos * (p * (1 - p))[:, None]).T @ pos) / len(pos) + all_ * hess + np.diag(ridge)
        step, size = np.linalg.solve(h, g), 1.0
        if g @ step < TOLERANCE ** 2 * 100:
            break
        while size > 1e-3:
            new = w - size * step
            got = _all_sums(rows, scale, new, n)
            then = value(new, got[0])
            if then <= now - 1e-4 * size * (g @ step):
                break
            size /= 4
        else:
            break
        w, now, (seen, grad, hess) = new, then, got
    return w, seen


# -- prior and classifier ------------------------------------------------------------------

def estimated_prior(rows: DataFrame, scale: Scale, n: int, pos: np.ndarray) -> tuple[float, np.ndarray]:
    """The class prior from one half of the positives, and the discriminator fitted on the other."""
    fit, check = pos[::2], pos[1::2]
    if not len(check):
        check = fit
    w, _ = _minimise(rows, scale, n, fit, np.zeros(pos.shape[1]), 1.0, 0.0, 1.0)
    edges = np.quantile(check @ w, np.linspace(0, 1, min(BINS, len(check) + 1)))

    def one(x):
        return np.bincount(np.searchsorted(edges, scale(x) @ w, side="right"), minlength=len(edges) + 1).astype(np.float64)

    every = _sums(rows, one, len(edges) + 1)
    mine = np.bincount(np.searchsorted(edges, check @ w, side="right"), minlength=len(edges) + 1)
    above = lambda c: np.cumsum(c[::-1])[::-1] / c.sum()
    q_all, q_pos = above(every), above(mine)
    some = (q_pos >= LEAST_ABOVE) & (q_all > 0)
    part, mine_ = np.where(some, q_all, 1), np.where(some, q_pos, 1)
    error = np.sqrt((1 - part) / (part * n) + (1 - mine_) / (mine_ * len(check)) + 1 / len(check) ** 2)
    bound = np.where(some, part / mine_ * (1 + DEVIATIONS * error), np.inf)
    at = int(np.argmin(bound))
    return float(np.clip(q_all[at] / q_pos[at], 1 / max(2, n), 1.0)), w


class Model:
    """Scale, weights, the estimated prior, and whether the negative part of the risk was held at zero."""

    def __init__(self, scale: Scale | None, w: np.ndarray | None, prior: float | None, held: bool):
        self.scale, self.w, self.prior, self.held = scale, w, prior, held

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), NO_POSITIVES)
        return _sigmoid(self.scale(x) @ self.w)


def non_negative_fit(rows: DataFrame, scale: Scale, n: int, pos: np.ndarray, prior: float, start: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights of least non-negative unbiased risk."""
    def at(mix: float, w: np.ndarray) -> tuple[np.ndarray, float]:
        w, seen = _minimise(rows, scale, n, pos, w, (1 - mix) * prior, mix * prior, mix)
        return w, seen - prior * _loss(-(pos @ w)).mean()

    w, negative = at(1.0, start)
    if negative >= -CLOSE:
        return w, False
    low, least = at(0.0, np.zeros(len(start)))
    if least <= CLOSE:
        return low, True
    # The negative part falls as the mixture grows: secants on a log scale, kept inside the bracket.
    lo, hi, up, down = -10.0, 0.0, least, negative
    for _ in range(SECANTS):
        t = np.clip((lo * -down + hi * up) / (up - down), lo + 0.1 * (hi - lo), hi - 0.1 * (hi - lo))
        w, negative = at(float(np.exp(t)), w)
        if abs(negative) <= CLOSE:
            break
        if negative > 0:
            lo, up, down = t, negative, down / 2
        else:
            hi, down, up = t, negative, up / 2
    return w, True


def _positives(rows: DataFrame, labels: DataFrame, sample: int) -> np.ndarray:
    """Features of at most ``sample`` trusted positives outside the held-out fifth: one row per doc_id."""
    known = (labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
                   .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("_q")).where("_q = 1")
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id"))
    got = (rows.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"))
               .orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    return _matrix(pa.array([bytes(r["x"]) for r in got], pa.binary())) if got else np.zeros((0, len(FEATURES)))


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, prior: float | None = None) -> Model:
    """Model from ``feature_rows`` and the trusted positives; ``prior`` replaces its estimate."""
    found = _positives(rows, labels, sample)
    if not len(found):
        return Model(None, None, None, False)
    scale, n = Scale.of(rows)
    pos = scale(found)
    estimate, start = estimated_prior(rows, scale, n, pos)
    prior = estimate if prior is None else prior
    w, held = non_negative_fit(rows, scale, n, pos, prior, start)
    return Model(scale, np.round(w, 9), prior, held)


# -- the operator ------------------------------------------------------------------------

def score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per feature row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(_matrix(batch.column(2))), pa.float64())],
                                                 names=["doc_id", "held_out", "score"])

    return (rows.mapInArrow(task, "doc_id long, held_out boolean, score double")
                .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    rows = feature_rows(docs)
    return score_rows(rows, train(rows, labels, sample))


def drop_poor(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (its own columns) without the rows that score below ``THRESHOLD``."""
    T.small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            yield batch.filter(pa.array(model.scores(features(batch.column(at)).astype(np.float32).astype(np.float64)) >= THRESHOLD))

    return docs.mapInArrow(task, docs.schema)
