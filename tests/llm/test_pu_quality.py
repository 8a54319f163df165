"""Positive-unlabelled quality: features by hand, the risk's minimum, the prior, held-out labels."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sortpub.llm import pu_quality as Q
from tests.conftest import SF
from tests.llm.helpers import awkward, docs_frame, empty, prose, words


def by_hand(text):
    raw = (text or "").encode()
    w = words(text)
    n, size = max(len(w), 1), max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x]
    grams = lambda k: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    distinct = lambda x: len(set(x)) / len(x) if x else 1.0
    return {
        "upper": sum(65 <= b <= 90 for b in raw) / size, "bang": raw.count(b"!") / size, "line": raw.count(b"\n") / size,
        "high": sum(b >= 128 for b in raw) / size, "long_words": sum(len(x) > 20 for x in w) / n,
        "same_as_last": sum(a == b for a, b in zip(w, w[1:])) / n, "distinct_words": distinct(grams(1)),
        "distinct_pairs": distinct(grams(2)), "distinct_triples": distinct(grams(3)), "distinct_lines": distinct(lines),
        "word_bytes": sum(map(len, w)) / n, "words_per_line": np.log1p(len(w) / max(len(lines), 1)),
        "log_words": np.log1p(len(w)), "log_bytes": np.log1p(len(raw)),
        "ended_words": sum(x[-1:] in (b".", b"?", b"!") for x in w) / n,
        "caps_words": sum(sum(65 <= b <= 90 for b in x) > 1 and not any(97 <= b <= 122 for b in x) for x in w) / n,
    }


def test_features():
    texts = [t for _, t in awkward()] + ["A!! BB!! CC\n\nA!! BB!! CC\n", "x\n", "\n\n", "one two one two one two.", "LOUD Words | and | pipes"]
    got = Q.features(pa.array(texts, pa.string()))
    for x, t in zip(got, texts):
        for name, value in by_hand(t).items():
            assert x[Q.FEATURES.index(name)] == pytest.approx(value), (name, t)


def plane(spark, seed, n, prior, apart):
    """Packed feature rows of two clouds, and positives of their own."""
    rng = np.random.default_rng(seed)
    k = len(Q.FEATURES)
    good = rng.random(n) < prior
    x = np.abs(rng.normal(2, 1, (n, k)))
    x[:, 0] += apart * good
    pos = np.abs(rng.normal(2, 1, (400, k)))
    pos[:, 0] += apart
    rows = spark.createDataFrame([(i, False, r.astype(np.float32).tobytes()) for i, r in enumerate(x)], "doc_id long, held_out boolean, x binary")
    return rows, x.astype(np.float32).astype(float), good, pos


def risk(w, prior, f_all, f_pos):
    z = f_pos @ w
    ridge = np.full(len(w), Q.RIDGE / np.sqrt(len(f_pos)))
    ridge[0] /= 100
    negative = Q._loss(-(f_all @ w)).mean() - prior * Q._loss(-z).mean()
    return prior * Q._loss(z).mean() + max(0.0, negative) + (ridge * w * w).sum() / 2, negative


@pytest.mark.parametrize("prior,apart,given", [(0.6, 3.0, 0.5), (0.5, 3.0, 0.65)])
def test_fit_minimises_the_non_negative_risk(spark, prior, apart, given):
    rows, x, good, found = plane(spark, 3, 1500, prior, apart)
    scale, n = Q.Scale.of(rows)
    assert n == 1500 and np.allclose(scale.mean, Q.Scale.bent(x).mean(axis=0), atol=1e-3)
    pos, every = scale(found), scale(x)
    w, held = Q.non_negative_fit(rows, scale, n, pos, given, np.zeros(pos.shape[1]))
    best, negative = risk(w, given, every, pos)
    assert held == (given > prior) and (not held or abs(negative) <= Q.CLOSE)
    rng = np.random.default_rng(0)
    for size in (0.3, 0.1, 0.03):
        for _ in range(60):
            assert risk(w + size * rng.normal(size=len(w)), given, every, pos)[0] >= best - 1e-3
    assert held or (((every @ w) > 0) == good).mean() > 0.85


def test_prior(spark):
    rows, _, good, found = plane(spark, 5, 6000, 0.7, 5.0)
    scale, n = Q.Scale.of(rows)
    prior, _ = Q.estimated_prior(rows, scale, n, scale(found))
    assert abs(prior - good.mean()) < 0.08


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or score is null").count() == 0
    r = got.join(labels, "doc_id").where("held_out").agg(
        F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept"),
        F.avg(F.when(F.col("quality") == 0, 1 - F.col("predicted"))).alias("dropped")).first()
    assert r["kept"] >= 0.97 and r["dropped"] >= 0.93


def test_labels_of_the_held_out_fifth_and_of_poor_texts_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.feature_rows(docs)
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b, c = (Q._positives(rows, x, 500) for x in (labels, other, labels.where("quality = 1")))
    assert len(a) > 20 and (a == b).all() and (a == c).all()
    assert len(Q._positives(rows, labels, 10)) <= 10


def test_awkward_rows(spark):
    rows = awkward() + [(400 + i, prose(i, 80)) for i in range(40)] + [(500 + i, "BUY!! " * (20 + i)) for i in range(10)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(400 + i, 1) for i in range(40)] + [(7, 1), (13, 1), (None, 1), (500, 0), (501, None), (400, 1)], "doc_id long, quality int")
    got = Q.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.held_out for r in got}[13] == (zlib.crc32(b"13") % 5 == 0) and not any(r.held_out for r in got if r.doc_id is None)
    same = [r.score for r in got if r.doc_id == 7]
    assert len(same) == 2 and same[0] == same[1]
    none = Q.quality(docs, labels.where("quality = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(Q.NO_POSITIVES, 1)}
    assert Q.quality(empty(spark), labels).count() == 0
    features = Q.feature_rows(docs)
    kept = Q.drop_poor(docs, Q.train(features, labels))
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
