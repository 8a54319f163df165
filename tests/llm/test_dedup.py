"""Suffix, near-duplicate, line and phrase dedup against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from sortpub.llm import line_dedup, phrase_dedup, recurrence, setsketch, suffix_dedup
from sortpub.llm import text as T
from tests.llm.helpers import awkward, docs_frame, empty, prose, words

LAST = (1 << 63) - 1


def order(rows):
    """Distinct documents in document order: doc_id (null last), then anything fixed."""
    return sorted({(LAST if d is None else d, d is None, t or "") for d, t in rows})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_suffix(rows):
    seen, out = {}, {}
    docs = order(rows)
    for k, (d, null, text) in enumerate(docs):
        b = text.encode()
        for p in range(len(b) - 99):
            seen.setdefault(b[p:p + 100], (k, p))
    for k, (d, null, text) in enumerate(docs):
        b = text.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if seen[b[p:p + 100]] < (k, p):
                gone[p:p + 100] = b"\1" * 100
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[None if null else d, text] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g)))
    return Counter((d, *out[d, t or ""]) for d, t in rows)


def brute_phrase(rows):
    docs = order(rows)
    least = {}
    for d, _, text in docs:
        w = words(text)
        for p in range(len(w) - 49):
            key = tuple(w[p:p + 50])
            least[key] = min(d, least.get(key, d))
    out = {}
    for d, null, text in docs:
        w = words(text)
        gone = bytearray(len(w))
        for p in range(len(w) - 49):
            if least[tuple(w[p:p + 50])] < d:
                gone[p:p + 50] = b"\1" * 50
        out[None if null else d, text] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return Counter((d, *out[d, t or ""]) for d, t in rows)


def unordered(rows):
    """Rows whose order among repeated doc_ids (by hash) does not matter to the result."""
    return [r for r in rows if r[1] != "different text, same id"]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffixes(spark, hot):
    rows = unordered(awkward())
    got = Counter(tuple(r) for r in suffix_dedup.suffix_digest(docs_frame(spark, rows), hot).collect())
    assert got == brute_suffix(rows)


def test_suffixes_kept_bytes(spark):
    rows = [(1, "a" + prose(5, 60)), (2, "bc" + prose(5, 60) + "d")]
    got = {r.doc_id: r for r in suffix_dedup.drop_repeats(docs_frame(spark, rows)).collect()}
    assert got[1].kept is None and bytes(got[2].kept).startswith(b"bc") and bytes(got[2].kept).endswith(b"d")
    assert got[2].n_bytes - got[2].n_removed == len(got[2].kept)


@pytest.mark.parametrize("hot", [phrase_dedup.HOT, 1])
def test_phrases(spark, hot):
    rows = awkward()
    got = Counter(tuple(r) for r in phrase_dedup.phrase_digest(docs_frame(spark, rows), hot).collect())
    assert got == brute_phrase(rows)


def test_automaton_finds_every_occurrence():
    """Overlapping, repeated and unpicked places, never across rows; unknown words between."""
    rng = np.random.default_rng(5)
    rows = [rng.choice([b"a", b"b", b"c\xc3\xa9"], n).tolist() for n in (0, 7, 8, 60, 400)] + [[b"a"] * 30]
    phrases = sorted({b" ".join(r[i:i + 8]) for r in rows[3:] for i in range(0, len(r) - 7, 3)}) + [b"never seen in any of these rows"]
    first = np.cumsum([0, *map(len, rows)]).tolist()
    at, which = phrase_dedup.occurrences(phrases, [w for r in rows for w in r], first)
    want = {(f + i, phrases.index(p)) for r, f in zip(rows, first) for i in range(len(r) - 7) if (p := b" ".join(r[i:i + 8])) in phrases}
    assert len(at) == len(want) and set(zip(at.tolist(), which.tolist())) == want
    none, _ = phrase_dedup.occurrences([], [b"a"], [0, 1])
    assert not len(none)


def test_leftmost_of_the_smallest():
    values = np.random.default_rng(6).integers(0, 9, 300).astype(np.uint64)
    low, at = phrase_dedup._leftmost(values, 43)
    for i in range(300 - 42):
        assert (low[i], at[i]) == (values[i:i + 43].min(), i + values[i:i + 43].argmin())


@pytest.mark.parametrize("hot", [phrase_dedup.HOT, 2])
def test_phrases_in_small_shards(spark, monkeypatch, hot):
    """Passages at unlike places, periodic text, phrases that one document picks and another only holds."""
    monkeypatch.setattr(phrase_dedup, "SHARD_BYTES", 3_000)
    monkeypatch.setattr(phrase_dedup, "HELD_PHRASES", 5)
    passage, round_words = prose(21, 120).split(), " ".join(f"w{i % 3}" for i in range(90))
    rows = [(i, " ".join([*prose(300 + i, i % 7).split(), *passage[i % 40:i % 40 + 50 + i % 31], *prose(400 + i, 20).split()])) for i in range(40)]
    rows += [(50, round_words), (51, "w2 " + round_words), (51, "x " + round_words), (52, round_words[:200]), (53, prose(7, 60)), (None, prose(7, 60))]
    got = Counter(tuple(r) for r in phrase_dedup.phrase_digest(docs_frame(spark, rows), hot).collect())
    assert got == brute_phrase(rows)


def test_many_documents_share_a_passage(spark):
    passage = prose(9, 70)
    rows = [(i, f"{prose(100 + i, 30)} {passage} {prose(500 + i, 30)}") for i in range(60)]
    frame = docs_frame(spark, rows)
    for hot in (5, 10_000):
        assert Counter(tuple(r) for r in phrase_dedup.phrase_digest(frame, hot).collect()) == brute_phrase(rows)
        assert Counter(tuple(r) for r in suffix_dedup.suffix_digest(frame, hot).collect()) == brute_suffix(rows)


def test_loser_tree_merges_and_knows_prefixes():
    rng = np.random.default_rng(3)
    rows = [bytes(rng.choice([97, 98], suffix_dedup.WIDTH).astype(np.uint8)) for _ in range(200)] + [b"a" * suffix_dedup.WIDTH] * 4
    for k in (1, 2, 5, 8):
        runs = [sorted(rows[i::k]) for i in range(k)]
        blobs = [suffix_dedup.front_code(np.frombuffer(b"".join(r), np.uint8).reshape(len(r), -1), np.arange(len(r)), np.arange(len(r))) for r in runs]
        out = [(key, shared) for _, _, key, shared in suffix_dedup.LoserTree([suffix_dedup.Run(b) for b in blobs])]
        assert [key for key, _ in out] == sorted(rows)
        for (a, _), (b, shared) in zip(out, out[1:]):
            assert shared == next((i for i in range(len(a)) if a[i] != b[i]), len(a))


def test_every_window_holds_a_pick():
    rng = np.random.default_rng(4)
    docs = [bytes(rng.choice([97, 98, 99], n).astype(np.uint8)) for n in (0, 5, 14, 15, 200, 333)] + [b"a" * 50]
    first = np.cumsum([0, *map(len, docs)])
    at, row, h = T.picks(T.byte_prefix(np.frombuffer(b"".join(docs), np.uint8)), first, 6, 10)
    for r, d in enumerate(docs):
        places = set((at[row == r] - first[r]).tolist())
        assert all(any(s + i in places for i in range(10)) for s in range(len(d) - 14))
    assert len(T.picks(T.byte_prefix(np.zeros(0, np.uint8)), np.zeros(3, np.int64), 6, 10)[0]) == 0


def test_spans_merge():
    r, s, e = recurrence.merge_spans(np.array([2, 1, 1, 1]), np.array([5, 0, 3, 20]), np.array([9, 4, 8, 30]))
    assert list(zip(r, s, e)) == [(1, 0, 8), (1, 20, 30), (2, 5, 9)]


def test_equal_slices_hash_alike():
    data = np.frombuffer(b"xxhello helloyy", np.uint8)
    pre = T.byte_prefix(data)
    a, b = T.slice_hash(pre, np.array([2, 8]), np.array([7, 13]))
    assert a == b != T.slice_hash(pre, np.array([3]), np.array([8]))[0]


# -- near duplicates ---------------------------------------------------------------------

def shingles(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = words(low.decode())
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute_near(rows, threshold):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        comp = d if not sets[i] else min((x for x in ids[find(i)] if x is not None), default=None)
        out[d, len(sets[i]), comp, d == comp] += 1
    return out


@pytest.mark.parametrize("threshold", [85, 80])
def test_near(spark, threshold):
    rows = awkward()
    got = Counter(tuple(r) for r in setsketch.near_duplicates(docs_frame(spark, rows), threshold).collect())
    assert got == brute_near(rows, threshold)


def test_near_chain_and_large_group(spark):
    """A chain whose ends are not linked, and a group of near copies that are not all linked to its first."""
    base = prose(21, 400).split(" ")
    rows = []
    for i in range(12):                              # each differs from the one before in one more place
        w = list(base)
        for k in range(i):
            w[10 + 30 * k] = f"edit{k}"
        rows.append((100 - i, " ".join(w)))
    group = prose(22, 300).split(" ")
    for i in range(40):
        w = list(group)
        for k in range(1 + i % 5):
            w[(i * 37 + k * 61) % 300] = f"new{i}x{k}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, prose(50 + i, 200)) for i in range(20)]
    got = Counter(tuple(r) for r in setsketch.near_duplicates(docs_frame(spark, rows), 85).collect())
    assert got == brute_near(rows, 85)


def test_near_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 7)
    monkeypatch.setattr(setsketch, "SALT", 3)
    test_near_chain_and_large_group(spark)


def test_registers_merge_and_estimate():
    """Registers of a union are the maximum of the registers."""
    a, b = (setsketch.shingle_sets(__import__("pyarrow").array([prose(s, 500)])) for s in (31, 32))
    both = np.unique(np.concatenate([a[0], b[0]]))
    one = np.maximum(setsketch.registers(*a), setsketch.registers(*b))
    assert (one == setsketch.registers(both, np.array([0, len(both)]))).all()


def test_keep_first(spark):
    rows = awkward()
    kept = setsketch.keep_first(docs_frame(spark, rows), 85)
    assert set(kept.columns) == set(docs_frame(spark, rows).columns)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    comps = {}
    for d, t in rows:
        if shingles(t):
            comps.setdefault(brute_component(rows, t, 85), set()).add(t)
    full = [g for g in got if shingles(g[1])]
    assert len(full) == len(comps)                   # one of each component
    assert sorted(str(g) for g in got if not shingles(g[1])) == sorted(str(r) for r in rows if not shingles(r[1]))


def brute_component(rows, text, threshold):
    """Texts linked with ``text``, as a frozen set (links are followed)."""
    texts = {t for _, t in rows if shingles(t)}
    comp, todo = {text}, [text]
    while todo:
        s = shingles(todo.pop())
        for t in texts - comp:
            u = shingles(t)
            if 100 * len(s & u) >= threshold * len(s | u):
                comp.add(t), todo.append(t)
    return frozenset(comp)


# -- lines -------------------------------------------------------------------------------

def brute_lines(rows, t):
    docs, seen, whole = order([r for r in rows if r[1] is not None]), {}, {}
    for k, (_, _, text) in enumerate(docs):
        lines = text.split("\n")
        if len(lines) < t and words(text):
            whole.setdefault(text, k)
        for i in range(len(lines) - t + 1):
            seen.setdefault(tuple(lines[i:i + t]), (k, i))
    out = {}
    for k, (d, null, text) in enumerate(docs):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - t + 1):
            if seen[tuple(lines[i:i + t])] < (k, i):
                gone |= set(range(i, i + t))
        if whole.get(text, k) < k:
            gone = set(range(len(lines)))
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[None if null else d, text] = (len(lines), len(gone), sha(kept.encode()), kept)
    return out


def line_rows():
    run = "one line\nsecond line\nthird line\nfourth line"
    return [(1, run), (2, "head\n" + run + "\ntail"), (3, "second line\nthird line"), (4, run + "\n" + run), (5, "a\n" * 12),
            (6, "\n\n\n\n"), (7, None), (8, ""), (None, run), (9, "x\nsecond line\nthird line\nfourth line\ny"), (2, "head\n" + run + "\ntail"), (None, None),
            (20, "two lines\nof a short text"), (21, "two lines\nof a short text"), (21, "two lines\nof a short text"), (22, "one line only"), (23, "one line only"),
            (24, "  "), (25, "  "), (None, "one line only")]


@pytest.mark.parametrize("t", [1, 2, 3])
def test_lines(spark, t):
    rows = line_rows() + [(d + 100 if d is not None else d, x) for d, x in awkward()[3:17]]
    want = brute_lines(rows, t)
    blank = (0, 0, sha(b""))
    got = Counter(tuple(r) for r in line_dedup.line_digest(docs_frame(spark, rows), t).collect())
    assert got == Counter((d, *(want[d, x][:3] if x is not None else blank)) for d, x in rows)


def test_lines_keep_columns(spark):
    frame = docs_frame(spark, line_rows())
    out = line_dedup.drop_repeated_runs(frame, 3)
    assert out.columns == frame.columns
    want = brute_lines(line_rows(), 3)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((d, want[d, x][3] if x is not None else None) for d, x in line_rows())


def test_empty_tables(spark):
    none = empty(spark)
    for f in (suffix_dedup.suffix_digest, phrase_dedup.phrase_digest, setsketch.near_duplicates, setsketch.keep_first, line_dedup.line_digest):
        assert f(none).count() == 0


def test_all_texts_null(spark):
    frame = docs_frame(spark, [(1, None), (2, None), (None, None)])
    for f in (suffix_dedup.suffix_digest, phrase_dedup.phrase_digest, setsketch.near_duplicates, line_dedup.line_digest):
        assert f(frame).count() == 3
