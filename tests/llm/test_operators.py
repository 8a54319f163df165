"""Decontamination, toxicity, sharding, top-k, mixing and licences against brute force or their laws."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sortpub.llm import decontaminate, licenses, mixing, sharding, topk_nra, toxicity, transducer
from sortpub.llm.components import components
from sortpub.llm.ranking import running_total
from tests.conftest import SF
from tests.llm.helpers import awkward, docs_frame, empty, prose, words


# -- decontamination ---------------------------------------------------------------------

def sellers(pattern, text):
    """Least edit distance of ``pattern`` to any substring of ``text``."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        diag, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            diag, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, diag + (p != c))
        best = min(best, row[-1])
    return best


def edited(text, places):
    out = list(text)
    for k, p in enumerate(places):
        out[p:p + 1] = [["z"], ["q", out[p]], []][k % 3]
    return "".join(out)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))


def test_leaks(spark):
    items = [(1, prose(1, 40)), (2, prose(2, 30).upper() + "!!"), (3, "short"), (4, None), (5, ""), (6, prose(3, 25)), (6, prose(3, 25)), (None, prose(4, 30))]
    a = prose(1, 40)
    n = len(decontaminate.normalise(a))
    e = int(n * decontaminate.BUDGET)
    rows = [(1, prose(11, 50) + " " + a + " " + prose(12, 50)), (2, prose(13, 20) + " " + edited(a, range(5, n - 5, n // (e - 1))) + " tail"),
            (3, edited(a, range(2, n - 2, max(1, n // (2 * e))))), (4, prose(2, 30).replace(" ", ",\n ")), (5, None), (6, ""), (None, prose(3, 25)),
            (7, a[: n // 2]), (1, prose(4, 30) + " x"), (8, prose(14, 3000))]
    got = Counter((r.doc_id, r.item_id, r.distance) for r in decontaminate.leak_pairs(docs_frame(spark, rows), items_frame(spark, items)).collect())
    want = Counter()
    for d, t in rows:
        for i, x in items:
            p = decontaminate.normalise(x)
            if len(p) >= decontaminate.MIN_CHARS:
                dist = sellers(p, decontaminate.normalise(t))
                if dist <= int(len(p) * decontaminate.BUDGET):
                    want[d, i, dist] += 1
            elif p and f" {p} " in f" {decontaminate.normalise(t)} ":
                want[d, i, 0] += 1
    assert got == want and (2, 1, max(k[2] for k in want)) in want
    # the same by several shards of items
    frame, test = docs_frame(spark, rows), items_frame(spark, items)
    many = decontaminate.leak_pairs(frame, test, shard_chars=300)
    assert Counter((r.doc_id, r.item_id, r.distance) for r in many.collect()) == want
    clean = decontaminate.drop_leaks(frame, test, shard_chars=300)
    assert clean.columns == frame.columns
    hit = {str(t) for (d, t) in rows if any(k[0] == d for k in want) and sellers_hit(t, items)}
    assert Counter(str(r.text) for r in clean.collect()) == Counter(str(t) for _, t in rows if str(t) not in hit)


def sellers_hit(text, items):
    norms = [decontaminate.normalise(x) for _, x in items]
    return any(len(p) >= decontaminate.MIN_CHARS and sellers(p, decontaminate.normalise(text)) <= int(len(p) * decontaminate.BUDGET) for p in norms)


def test_myers_equals_sellers():
    rng = np.random.default_rng(1)
    for _ in range(200):
        p = "".join(rng.choice(list("abc"), rng.integers(1, 90)))
        t = "".join(rng.choice(list("abc"), rng.integers(0, 120)))
        assert decontaminate.best_distance(decontaminate.masks(p), len(p), t) == sellers(p, t)


def test_one_error():
    rng = np.random.default_rng(2)
    for _ in range(2000):
        h = "".join(rng.choice(list("ab"), rng.integers(1, 7)))
        t = "".join(rng.choice(list("ab"), rng.integers(0, 9)))
        want = any(sellers_prefix(h, t[:n]) <= 1 for n in range(len(t) + 1))
        assert decontaminate.one_error(h, t[:len(h) + 1]) == want, (h, t)


def sellers_prefix(a, b):
    row = list(range(len(a) + 1))
    for c in b:
        diag, row[0] = row[0], row[0] + 1
        for i, p in enumerate(a, 1):
            diag, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, diag + (p != c))
    return row[-1]


def test_short_and_repeated_items(spark):
    items = [(1, "What is 7 x 8?"), (2, "Yes."), (3, "?!"), (4, "what is 7 x 8"), *[(5, prose(1, 30))] * 40, (None, "yes")]
    rows = [(1, "Quiz: what  is 7 X 8? Think."), (2, "What is 7 x 81?"), (3, "yes"), (4, "yesterday"), (5, None), (6, "?!"), (7, prose(1, 30))]
    docs, test = docs_frame(spark, rows), items_frame(spark, items)
    want = Counter({(1, 1, 0): 1, (1, 4, 0): 1, (3, 2, 0): 1, (3, None, 0): 1, (7, 5, 0): 40})
    for chars in (20, decontaminate.SHARD_CHARS):
        got = decontaminate.leak_pairs(docs, test, shard_chars=chars)
        assert Counter((r.doc_id, r.item_id, r.distance) for r in got.collect()) == want
        clean = decontaminate.drop_leaks(docs, test, shard_chars=chars)
        assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 5, 6]       # "yes" alone is no leak


def test_leaks_of_empty_tables(spark):
    docs, items = docs_frame(spark, awkward()), items_frame(spark, [(1, prose(1, 30))])
    assert decontaminate.leak_pairs(empty(spark), items).count() == 0
    assert decontaminate.leak_pairs(docs, items.where("false")).count() == 0
    assert decontaminate.drop_leaks(docs, items.where("false")).count() == len(awkward())


# -- toxicity ----------------------------------------------------------------------------

def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in got.collect() if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tox = [r for r in rows if truth[r.doc_id]]
    assert sum(r.predicted for r in tox) >= 0.9 * len(tox)
    assert sum(r.predicted for r in rows if not truth[r.doc_id]) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_clause_machine():
    g = toxicity.Grammar({"fool": 4.0, "blorg*": 3.0})
    score = lambda t: math.expm1(g.features(t)[0])
    assert score("the weather is fine today.") == 0
    plain = score("such a fool there.")
    assert plain == pytest.approx(4.0)
    assert score("you fool.") > plain                              # a person in the clause
    assert score("not a fool.") < plain                            # negated
    assert score("the letter said fool.") < plain                  # reported
    assert score("a blorgish thing") == pytest.approx(3.0)         # stem
    assert score("kill the process.") == 0 and score("kill them.") > 0      # a threat needs a person
    assert score("you are here. a fool.") == pytest.approx(plain)  # clauses don't mix


def accepting_paths(machines, symbols):
    """Weights of all accepting paths of the cascade, by enumerating every choice of start states and arcs."""
    out = []

    def walk(states, i, weight):
        if i == len(symbols):
            if all(s in m.finals for s, m in zip(states, machines)):
                out.append(weight)
            return
        def pass_on(k, symbol, factor, after):
            if k == len(machines):
                walk(tuple(after), i + 1, weight + (factor * symbols[i][1] if symbol == transducer.HIT else 0.0))
                return
            for arc in machines[k].arcs:
                if arc.state == states[k] and arc.reads == symbol:
                    pass_on(k + 1, arc.writes, factor * arc.factor, [*after, arc.next])

        pass_on(0, symbols[i][0], 1.0, [])

    for starts in itertools.product(*(m.starts for m in machines)):
        walk(starts, 0, 0.0)
    return out


def clause_by_rules(symbols):
    """The grammar told in words: what a clause scores, read off its whole list of words."""
    total, negated, quoted = 0.0, False, False
    persons = [i for i, (c, _) in enumerate(symbols) if c == "target"]
    person = persons[0] if persons else None
    for i, (c, value) in enumerate(symbols):
        weak = (toxicity.NEGATED if negated else 1.0) * (toxicity.REPORTED if quoted else 1.0)
        if c == "insult":
            total += value * weak * (toxicity.PERSON_GAIN if persons else 1.0)
            negated = False
        elif c == "threat" and persons and i > person:
            total += toxicity.THREAT_WEIGHT * weak / 2
        elif i == person and any(k == "threat" for k, _ in symbols[:i]):
            total += toxicity.THREAT_WEIGHT * weak * toxicity.PERSON_GAIN
        negated, quoted = negated or c == "negation", quoted or c == "report"
    return total


def test_composition_by_path_enumeration():
    g = toxicity.Grammar({})
    value = {"insult": 2.5}
    clauses = [[(c, value.get(c, 1.0)) for c in w] for n in range(5) for w in itertools.product(toxicity.WORDS, repeat=n)]
    rng = random.Random(5)
    clauses += [[(c, rng.choice((1.5, 4.0)) if c == "insult" else 1.0) for c in rng.choices(toxicity.WORDS, k=9)] for _ in range(200)]
    for symbols in clauses:
        paths = accepting_paths(toxicity.TRANSDUCERS, symbols)
        assert len(paths) == 1, symbols
        assert g.clause(symbols) == pytest.approx(paths[0]) == pytest.approx(clause_by_rules(symbols)), symbols


def test_toxicity_repeated_sample_ids(spark):
    rows = [(1, f"mean zork {i}") for i in range(50)] + [(1, None), (2, "a calm day"), (3, "zork you")]
    labels = spark.createDataFrame([(d, 1, int(d != 2)) for d in (1, 2, 3)], "doc_id long, quality int, toxic int")
    got = toxicity._sample(docs_frame(spark, rows), labels, 10).collect()
    learned = [d for d in (1, 2, 3) if zlib.crc32(str(d).encode()) % 5]
    assert len(got) == len(learned)                  # one text for each sampled id


def test_toxicity_edges(spark):
    rows = awkward() + [(50 + i, f"you are a grozz {prose(i, 20)}") for i in range(30)] + [(100 + i, prose(200 + i, 25)) for i in range(60)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(d, 1, 1 if t and "grozz" in t else 0) for d, t in rows if d is not None and d >= 20] +
                                   [(None, 1, 1), (51, None, None), (60, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    by = {r.doc_id: r.predicted for r in got}
    assert all(by[50 + i] == 1 for i in range(30)) and all(by[100 + i] == 0 for i in range(60))
    assert not any(r.held_out for r in got if r.doc_id is None)
    again = toxicity.toxicity(docs, labels)
    assert Counter(map(tuple, got)) == Counter(map(tuple, again.collect()))
    for none in (labels.where("false"), labels.where("toxic = 1")):
        assert toxicity.toxicity(docs, none).count() == len(rows)
    assert toxicity.toxicity(empty(spark), labels).count() == 0
    model = toxicity.train(docs, labels)
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == len(rows) - sum(r.predicted for r in got)


# -- sharding ----------------------------------------------------------------------------

def check_shards(rows, out, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    by = defaultdict(list)
    for r in out:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    split = defaultdict(set)
    for r in out:
        split[r.size, r.text_crc32].add(r.shard)
    return sum(len(v) - 1 for v in split.values())


def test_shards_keep_groups_together(spark):
    rows = [(i, prose(i // 3, 12)) for i in range(150)] + [(200 + i, prose(500 + i, 10)) for i in range(90)]
    out = sharding.balanced_shards(docs_frame(spark, rows), 6).collect()
    assert check_shards(rows, out, 6) == 0


@pytest.mark.parametrize("rows", [awkward(), [(i, "same") for i in range(50)], [(i, "same" if i % 3 else prose(i, 5)) for i in range(100)], [(1, "a"), (1, "a")]])
def test_shards_law(spark, rows):
    out = sharding.balanced_shards(docs_frame(spark, rows), 5).collect()
    cut = check_shards(rows, out, 5)
    largest = Counter(t or "" for _, t in rows).most_common(1)[0][1]
    if largest > 40:                                 # a hot group takes as few shards as it fits in, or one more
        assert cut <= -(-largest // (len(rows) // 5)) + 1


def test_shards_without_free_seats(spark):
    rows = [(i, prose(i // 2, 12)) for i in range(480)]        # every text twice: no seat is ever free
    out = sharding.balanced_shards(docs_frame(spark, rows), 6).collect()
    assert check_shards(rows, out, 6) <= 5
    rows = [(i, prose(i // 2, 12)) for i in range(400)] + [(400 + i, prose(900 + i // 3, 12)) for i in range(150)] + [(600, "alone")]
    out = sharding.balanced_shards(docs_frame(spark, rows), 6).collect()
    assert check_shards(rows, out, 6) <= 15                    # of 249 groups, one per pair of shards


def test_flow_grants_circles_and_chains():
    grant = sharding._flow
    assert grant({(0, 1): 5, (1, 0): 3}, {}, [0, 0]) == ({(0, 1): 3, (1, 0): 3}, {})
    assert grant({(0, 1): 2, (1, 2): 4, (2, 0): 3}, {}, [0, 0, 0])[0] == {(0, 1): 2, (1, 2): 2, (2, 0): 2}
    assert grant({(0, 1): 2, (1, 2): 4}, {}, [0, 0, 3])[0] == {(0, 1): 2, (1, 2): 3}
    assert grant({}, {(0, 1): 7}, [0, 0]) == ({}, {(0, 1): 3, (1, 0): 3})
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 7))
        wish = {(a, b): int(rng.integers(0, 9)) for a in range(n) for b in range(n) if a != b}
        tied = {(a, b): int(rng.integers(0, 9)) for a in range(n) for b in range(a + 1, n)}
        free = [int(x) for x in rng.integers(0, 3, n)]
        one, two = grant(wish, tied, free)
        assert all(0 <= k <= wish[p] for p, k in one.items())
        assert all(two.get((a, b), 0) + two.get((b, a), 0) <= k for (a, b), k in tied.items())
        both = Counter(one) + Counter(two)
        for s in range(n):
            assert sum(k for (_, b), k in both.items() if b == s) - sum(k for (a, _), k in both.items() if a == s) <= free[s]


def test_shards_of_nothing(spark):
    assert sharding.balanced_shards(empty(spark)).count() == 0


# -- top k -------------------------------------------------------------------------------

def brute_top(rows, k, step):
    ok = {(d, tuple(int(math.floor(64 * float(np.float32(x)))) for x in v)) for d, v in rows
          if d is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for d, q in ok:
        if d % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), e) for e, v in ok if e != d)[:k]
            out += [(d, i + 1, e, -s) for i, (s, e) in enumerate(scores)]
    return Counter(out)


def vectors(n, dim, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, spread, dim)]) for i in range(n)]


@pytest.mark.parametrize("block", [16, 2048])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk_nra, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_nra, "BLOCK_QUERIES", 4)
    monkeypatch.setattr(topk_nra, "GROUP_QUERIES", 8)
    rows = vectors(300, 8, 1) + [(1000 + i, [0.5] * 8) for i in range(40)]          # ties
    rows += [(400, None), (420, [None] * 8), (440, [float("nan")] * 8), (460, [float("inf")] + [0.0] * 7), (None, [0.1] * 8),
             (480, [0.25, -0.5]), (500, []), (60, rows[60][1]), (520, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("rank", F.lit(1))
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_nra.top_k(df, 5, 20).collect())
    assert got == brute_top(rows, 5, 20)


def test_lists_are_read_in_order_and_only_as_far(monkeypatch):
    """Bounds hold at every depth, and what a step brings are the lists' next entries."""
    rng = np.random.default_rng(3)
    x, w = rng.integers(-50, 50, (40, 6)), rng.integers(-50, 50, (5, 6))
    lists = topk_nra.Lists(np.arange(40), x)
    both = np.concatenate([np.maximum(w, 0), np.minimum(w, 0)], axis=1)
    scores, total, before = x @ w.T, 0, 0
    for depth in (1, 7, 25, 40):
        total = total + lists.read(before, depth, np.int64) @ both.T
        assert (total + lists.frontier(depth, np.int64) @ both.T >= scores).all()
        assert (total + lists.last(depth, np.int64) @ both.T <= scores).all()
        for d in range(6):
            assert sorted(x[lists.order[40 - depth:, d], d]) == sorted(x[:, d])[40 - depth:]
        before = depth
    assert (total == scores).all()
    # A block whose greatest values stay below every bar isn't read at all.
    search = topk_nra.Search(np.array([100]), np.array([[1, 1]]), 2)
    search.block(topk_nra.Lists(np.arange(3), np.array([[9, 9], [8, 8], [7, 7]])))
    monkeypatch.setattr(topk_nra.Lists, "read", lambda *a: pytest.fail("read"))
    search.block(topk_nra.Lists(np.arange(3, 6), np.ones((3, 2), int)))
    assert list(search.v) == [0, 1] and list(search.s) == [18, 16]


def test_top_k_repeated_ids(spark):
    rows = vectors(60, 4, 2) + [(20, [9.0] * 4), (20, [-9.0, 1.0, 1.0, 1.0]), (7, [5.0] * 4), (8, [-9.0] * 4)]
    first = {}
    for v, x in rows:
        first[v] = min(first.get(v, x), x)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_nra.top_k(df, 20, 20).collect())
    assert got == brute_top(list(first.items()), 20, 20) and max(got.values()) == 1


def test_top_k_large_values_and_few_rows(spark):
    rows = [(i, [1e5 * (i - 3), -2e4 * i, 3.0]) for i in range(0, 100, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_nra.top_k(df, 20, 20).collect())
    assert got == brute_top(rows, 20, 20)
    assert topk_nra.top_k(df.where("false")).count() == 0
    assert topk_nra.top_k(df.where("vec_id = 0")).count() == 0


# -- mixing ------------------------------------------------------------------------------

def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            break
        level = (goal - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        more = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        capped |= more
    return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in names}


def test_mix(spark):
    rows = [(i, prose(i, 5 + i % 90), f"src{i % 7}" if i % 7 < 6 else None) for i in range(600)] + [(700, prose(1, 4000), "src1"), (701, None, "src2"),
            (702, "", "empty"), (703, None, "empty"), (None, prose(2, 10), "src3"), (5, prose(5, 10), "src5"), (5, prose(5, 10), "src5")]
    frame = docs_frame(spark, rows)
    got = mixing.mix_digest(frame).collect()
    sizes = defaultdict(int)
    longest = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
        longest[s] = max(longest[s], len(words(t)))
    want = targets(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    source = defaultdict(set)
    for d, t, s in rows:
        source[d, len(words(t))].add(s)
    taken = defaultdict(int)
    for r in got:
        (s,) = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-12)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_digest(frame.repartition(5)).collect()))
    mixed = mixing.mixed_rows(frame)
    assert mixed.columns == frame.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_digest(empty(spark)).count() == 0 and mixing.mixed_rows(empty(spark)).count() == 0


# -- licences ----------------------------------------------------------------------------

def dice(a, b):
    a, b = licenses.bigrams(licenses.normalise(a)), licenses.bigrams(licenses.normalise(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_licenses(spark):
    t = licenses.TEMPLATES
    rows = [(1, "some text\n" + t["mit"]), (2, t["mit-grant"].replace(" of ", "\nof ")), (3, "LICENSED under cc by-nc 3.0"), (4, None), (5, ""), (None, t["gpl"]),
            (6, prose(1, 3000)), (7, "this work is licensed under the GNU general licence version 2"), (8, "license " * 60), (1, t["mit"]), (9, "a\n\nb\n" + t["bsd"] + "\n\nc"),
            (10, "\n".join(t.values()))]
    got = Counter(map(tuple, licenses.license_scan(docs_frame(spark, rows)).collect()))
    want = Counter()
    for d, text in rows:
        for name, body in t.items():
            scores = [x for x in (dice(u, body) for u in licenses.units(text or "")) if x >= licenses.THRESHOLD]
            if scores:
                want[d, name, max(scores), len(scores)] += 1
    assert got == want and any(k[0] is None for k in want)
    assert licenses.license_scan(empty(spark)).count() == 0


def test_licenses_in_windows(spark):
    apache, gpl = (licenses.HEADERS[n] for n in ("apache-2.0-notice", "gpl-notice"))
    wrap = lambda t, n, mark, end: end.join(mark + " ".join(t.split(" ")[i:i + n]) for i in range(0, len(t.split(" ")), n))
    rows = [(1, prose(1, 5) + " Released under the MIT License. " + prose(2, 5)), (2, wrap(prose(3, 40) + " " + licenses.TEMPLATES["mit-grant"], 9, " * ", "\n")),
            (3, prose(4, 20) + "\r\n\r\n" + wrap(licenses.TEMPLATES["bsd"], 6, "# ", "\r\n") + "\r\n\r\n" + prose(5, 30)),
            (4, wrap("Copyright 2020 " + prose(6, 3) + " " + apache, 10, "# ", "\n#\n") + "\nimport os"), (5, wrap(gpl, 10, "// ", "\r\n")),
            (6, prose(7, 400)), (7, "released the license under mit " * 30), (8, "so this work is licensed under the " + prose(8, 10) + " general public license version 3")]
    out = licenses.license_scan(docs_frame(spark, rows)).collect()
    got = defaultdict(dict)
    for r in out:
        got[r.doc_id][r.license] = (r.dice, r.n_units)
    assert got[1]["mit"] == (1.0, 1) and got[2]["mit-grant"] == (1.0, 1) and got[3]["bsd"] == (1.0, 1)
    assert got[4]["apache-2.0-notice"] == (1.0, 1) and got[5]["gpl-notice"] == (1.0, 1)
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.THRESHOLD, licenses.HEADERS)
    for d, text in rows:                             # every window by brute force
        w = licenses.normalise(text)
        g = list(zip(w, w[1:]))
        for size, name, want in scanner.sought:
            if all(dice(u, t) < licenses.THRESHOLD for u in licenses.units(text) for t in licenses.TEMPLATES.values()):
                longest = int(size * scanner.ratio + 1e-6)
                best = max((2 * len(want & set(g[i:j])) / (len(set(g[i:j])) + size) for i in range(len(g)) if g[i] in want
                            for j in range(i + 1, min(len(g), i + longest) + 1)), default=0)
                assert got[d].get(name, (0,))[0] == (best if best >= licenses.THRESHOLD else 0), (d, name)


# -- helpers -----------------------------------------------------------------------------

def test_running_total(spark):
    df = spark.range(0, 500).select("id", (F.col("id") % 7).alias("n"))
    got = {r.id: r.before for r in running_total(df, ["id"], "n", "before", block=37).collect()}
    assert got == {i: sum(k % 7 for k in range(i)) for i in range(500)}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (300, 300), (201, 200)]
    got = {r.c: r.comp for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 201: 100}
    assert components(spark.createDataFrame(links, "u long, v long").where("false")).count() == 0


# -- pipeline ----------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, step = docs, None
    seen = []
    for name, f in corpus_pipeline.STAGES:
        step = corpus_pipeline.stage(f(spark, docs, SF), name)
        if name != "sharding":
            assert step.columns == first.columns
        seen.append(step.count())
        docs = step
    assert seen[0] < first.count() and seen[1] <= seen[0] and seen[3] == seen[4]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    rows = [(*r, f"s{i % 3}" if i % 4 else None) for i, r in enumerate(awkward())]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, prose(1, 300)), (None, None)], "item_id long, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (docs, docs.where("false"), docs.withColumn("text", F.lit(None).cast("string"))):
        for name, f in corpus_pipeline.STAGES:
            out = corpus_pipeline.stage(f(spark, some, str(tmp_path)), name)
            if name != "sharding":
                assert out.columns == some.columns
            assert out.count() <= 2 * some.count()
