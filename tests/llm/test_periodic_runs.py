"""Periodic runs against brute force: every lag of every document, word by word."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sortpub.llm import periodic_runs as P
from tests.llm.helpers import awkward, docs_frame, empty, prose, words


def brute(x):
    """{(start, end): smallest period} of all runs of a list: every lag, word against word."""
    x, got = np.unique(np.array(x, dtype=object), return_inverse=True)[1] if len(x) else np.zeros(0, np.int64), {}
    for d in range(1, len(x) // P.REPEATS + 1):
        differ = np.flatnonzero(np.concatenate(([True], x[d:] != x[:-d], [True]))) - 1
        long = np.flatnonzero(np.diff(differ) - 1 + d >= max(P.MIN_WORDS, P.REPEATS * d))
        for a, b in zip(differ[long], differ[long + 1]):
            if b - a > 1:
                got.setdefault((int(a) + 1, int(b) + d), d)
    return got


def digest(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = sorted((s, e - s, q) for (s, e), q in brute(w).items())
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def mixed_rows(rng):
    """Rows of blocks that repeat, nested blocks and noise, of small and large alphabets."""
    rows = []
    for _ in range(rng.integers(1, 6)):
        parts = [np.zeros(0, np.int64)]
        for _ in range(rng.integers(0, 5)):
            letters = int(rng.choice([1, 2, 2, 3, 30]))
            block = rng.integers(0, letters, rng.integers(1, 90))
            if rng.random() < 0.5:
                inner = np.tile(rng.integers(0, letters, rng.integers(1, 9)), rng.integers(1, 12))
                block = np.concatenate([block, inner]) if rng.random() < 0.7 else inner
            parts.append(np.resize(block, int(len(block) * rng.random() * 6)))
            parts.append(rng.integers(0, 40, rng.integers(0, 20)))
        rows.append(np.concatenate(parts))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        rows = mixed_rows(rng)
        first = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
        s, e, d = P.runs(np.concatenate(rows).astype(np.uint64), first)
        want = sorted((a + first[i], z + first[i], q) for i, x in enumerate(rows) for (a, z), q in brute(x.tolist()).items())
        assert sorted(zip(s.tolist(), e.tolist(), d.tolist())) == want


def test_long_periods_of_every_scale():
    rng = np.random.default_rng(9)
    for q in (15, 16, 17, 31, 32, 63, 64, 65, 127, 128, 500, 1023, 1024):
        x = np.concatenate([rng.integers(0, 9, 7), np.resize(rng.integers(0, 1000, q), 3 * q), [99, 98]])
        s, e, d = P.runs(x.astype(np.uint64), np.array([0, len(x)]))
        assert {(a, z): p for a, z, p in zip(s.tolist(), e.tolist(), d.tolist())} == brute(x.tolist())
        assert q in d


def test_equal_hashes_of_unequal_words_decide_nothing():
    """Thue-Morse words of both kinds hash alike modulo 2 ** 64 from a length of 2 ** 11 on."""
    t = np.array([bin(i).count("1") & 1 for i in range(2048)])
    x = np.concatenate([t, 1 - t, t, 1 - t, t]).astype(np.uint64)
    s, e, d = P.runs(x, np.array([0, len(x)]))
    assert {(a, z): p for a, z, p in zip(s.tolist(), e.tolist(), d.tolist())} == brute(x.tolist())


def test_digest_of_awkward_rows(spark):
    block = prose(5, 40)
    rows = awkward() + [(100, " ".join([block] * 3)), (101, "a b " * 11 + "a b"), (102, "a " * 23), (103, "a " * 24), (104, "la\n" * 30 + "x " + "lo lu " * 40)]
    rows += [(i, prose(i, 30 + 7 * i)) for i in range(200, 260)]
    got = [tuple(r) for r in P.run_digest(docs_frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted((digest(d, t) for d, t in rows), key=str)
    assert any(r[1] > 1 for r in got) and sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got) > 3
    assert P.run_digest(empty(spark)).count() == 0


def test_runs_and_collapsed_texts(spark):
    rows = awkward() + [(300, "start " + "one two three " * 9 + "end"), (301, "z " * 50)]
    frame = docs_frame(spark, rows)
    want = sorted((d, s, e - s, q) for d, t in rows if d is not None for (s, e), q in brute(words(t)).items())
    assert sorted(tuple(r) for r in P.periodic_runs(frame).where("doc_id is not null").collect()) == want
    texts = {r.doc_id: (r.collapsed, r.n_dropped) for r in P.collapse_runs(frame).collect()}
    assert texts[300] == ("start one two three end", 24) and texts[301] == ("z", 49) and texts[1] == ("", 0)
    assert P.periodic_runs(empty(spark)).count() == 0 and P.collapse_runs(empty(spark)).count() == 0
