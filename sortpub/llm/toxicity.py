"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers, each a weighted table (``TRANSDUCERS``), are composed into one machine
(``transducer``); it reads the classes of a clause's words, and each transducer reads what the one before wrote:

* target: is a person spoken to or about?  It guesses at the clause's start whether one comes and
  dies on a wrong guess, so that insults before the person are raised like those behind; a threat's
  verb behind the person is passed on as ``late``;
* threat: a verb of harm is armed until the person comes, or half as heavy where it comes late;
* insult: words and word stems of the lexicon become hits of their own weight;
* negation: halves the next hit; an insult uses the negation up, a threat leaves it;
* reported speech: lowers every hit behind a verb of saying.

A clause's score is the weight of its accepting path (there is exactly one).  A document's score is a
logistic function of the sum over its matched clauses, of that sum per 100 words, and of the
number of clauses that match.

Insult stems are learned from labelled rows: the documents that hold a word (or a word's first
letters) are counted by label over a sample of at most ``SAMPLE_ROWS`` labelled documents (by hash of doc_id, so
the same on every run; of several texts of one doc_id the smallest), and words with a clear log odds ratio enter the lexicon (at most
``LEXICON`` of them).  The three coefficients are fitted on the same sample.  Label, lang, source
and doc_id are no inputs of a score.

Null and empty texts score like a text without any match; a null doc_id is scored and counts as not
held out; repeated rows score alike; empty tables, and labels of one kind only, leave the seed list
and default coefficients; other columns are carried by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.llm.text import small_batches
from sortpub.llm.transducer import HIT, SKIP, Machine, Runner, compose, machine
from sortpub.session import stage

SAMPLE_ROWS = 20_000
LEXICON = 2_000
COUNTED_WORDS = 200_000 # distinct words a task holds before it sends their counts
MIN_ROWS = 4            # toxic rows that must hold a learned word
MIN_LOG_ODDS = 3.0
STEM_LETTERS = (4, 5, 6)

# The grammar's words.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "clown", "clowns",
           "pathetic", "worthless", "disgusting", "imbecile", "dumb", "filth", "vermin", "garbage", "bastard")
THREATS = ("kill", "hurt", "stab", "shoot", "destroy", "beat", "burn", "strangle", "smash", "hunt")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "people", "du", "dich", "ihr", "euch",
           "tu", "toi", "vous", "usted", "ustedes", "ellos")
NEGATIONS = ("not", "no", "never", "none", "cannot", "nicht", "kein", "keine", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "called", "calls", "claimed", "quoted", "reported", "according", "allegedly",
           "sagte", "schrieb", "disait", "dijo")
SEED_WEIGHT = 4.0
THREAT_WEIGHT = 3.0
PERSON_GAIN = 1.25
NEGATED = 0.5
REPORTED = 0.6
DEFAULT_COEFFICIENTS = (-2.5, 0.9, 0.4, 0.3)

_TOKEN = re.compile(r"\w+|[.!?;|\n]")
_ENDS = frozenset(".!?;|\n")
_END = ("end", 0.0)
_LIVE = frozenset(("insult", "threat"))

# The transducers: (state, symbol) -> (next state, output, factor).
WORDS = ("insult", "threat", "target", "negation", "report")
TARGET = machine(("alone", "ahead"), ("alone", "met"), WORDS, {
    ("ahead", "insult"): ("ahead", "insult", PERSON_GAIN), ("met", "insult"): ("met", "insult", PERSON_GAIN),
    ("alone", "target"): None, ("ahead", "target"): ("met", "person", PERSON_GAIN), ("met", "target"): ("met", SKIP, 1.0),
    ("met", "threat"): ("met", "late", 0.5)})
THREAT = machine(("idle",), ("idle", "armed"), ("insult", "threat", "late", "person", "negation", "report", SKIP), {
    ("idle", "threat"): ("armed", SKIP, 1.0), ("armed", "threat"): ("armed", SKIP, 1.0),
    ("idle", "late"): ("idle", "harm", THREAT_WEIGHT), ("armed", "late"): ("armed", "harm", THREAT_WEIGHT),
    ("idle", "person"): ("idle", SKIP, 1.0), ("armed", "person"): ("armed", "harm", THREAT_WEIGHT)})
INSULT = machine(("read",), ("read",), ("insult", "harm", "negation", "report", SKIP), {
    ("read", "insult"): ("read", "abuse", 1.0)})
NEGATION = machine(("plain",), ("plain", "negated"), ("abuse", "harm", "negation", "report", SKIP), {
    ("plain", "negation"): ("negated", SKIP, 1.0), ("negated", "negation"): ("negated", SKIP, 1.0),
    ("plain", "abuse"): ("plain", HIT, 1.0), ("negated", "abuse"): ("plain", HIT, NEGATED),
    ("plain", "harm"): ("plain", HIT, 1.0), ("negated", "harm"): ("negated", HIT, NEGATED)})
REPORT = machine(("own",), ("own", "quoted"), (HIT, "report", SKIP), {
    ("own", "report"): ("quoted", SKIP, 1.0), ("quoted", "report"): ("quoted", SKIP, 1.0),
    ("quoted", HIT): ("quoted", HIT, REPORTED)})
TRANSDUCERS: tuple[Machine, ...] = (TARGET, THREAT, INSULT, NEGATION, REPORT)


class Grammar:
    """The composed machine.  Symbols come from the five word classes; any other word is skipped."""

    def __init__(self, lexicon: dict[str, float]):
        """``lexicon``: learned weights; a stem ends in ``*``."""
        self.words = {w: SEED_WEIGHT for w in INSULTS}
        self.words.update({w: x for w, x in lexicon.items() if not w.endswith("*")})
        self.stems = {w[:-1]: x for w, x in lexicon.items() if w.endswith("*")}
        self.sizes = tuple(sorted({len(s) for s in self.stems}))
        self.marks = {**{w: "threat" for w in THREATS}, **{w: "target" for w in TARGETS},
                      **{w: "negation" for w in NEGATIONS}, **{w: "report" for w in REPORTS}}
        self.known = _Symbols(self)
        self.clause = Runner(reduce(compose, TRANSDUCERS)).weight

    def symbol(self, word: str) -> tuple[str, float] | None:
        if word in _ENDS:
            return _END
        if word in self.words:
            return "insult", self.words[word]
        if word in self.marks:
            return self.marks[word], 1.0
        best = max((self.stems[word[:n]] for n in self.sizes if word[:n] in self.stems), default=0.0)
        return ("insult", best) if best else None

    def features(self, text: str | None) -> tuple[float, float, float]:
        """(sum over matched clauses, that per 100 words, matched clauses), each on a log scale."""
        tokens = _TOKEN.findall((text or "").lower())
        known = self.known
        total, matched, clause, live = 0.0, 0, [], False
        for got in [*filter(None, [known[t] for t in tokens]), _END]:
            if got is not _END:
                clause.append(got)
                live = live or got[0] in _LIVE
            elif clause:
                if live:
                    s = self.clause(clause)
                    total, matched = total + s, matched + (s > 0)
                clause, live = [], False
        return math.log1p(total), math.log1p(100 * total / max(len(tokens), 1)), math.log1p(matched)


class _Symbols(dict):
    """Words seen so far and their symbols (a cache of bounded size)."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, word: str) -> tuple[str, float] | None:
        got = self.grammar.symbol(word)
        if len(self) < 50_000:
            self[word] = got
        return got


class Model:
    def __init__(self, lexicon: dict[str, float], coefficients: tuple[float, ...] = DEFAULT_COEFFICIENTS):
        self.lexicon, self.coefficients = lexicon, tuple(float(c) for c in coefficients)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _words_of(text: str) -> set[str]:
    words = {w for w in _TOKEN.findall((text or "").lower()) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in STEM_LETTERS if len(w) > n}


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the held-out fifth, one text each, staged.

    The ids and labels of the sample are broadcast (``rows`` bounds them); of the texts, a task sends on one
    per sampled doc_id at most, however often that id is repeated.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                   .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stage(texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
                      .select("text", "toxic"), "toxic_sample")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and coefficients from the labelled sample (bounded by ``rows``)."""
    small_batches(docs.sparkSession)
    sample = _sample(docs, labels, rows)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(n: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(n[kind]), pa.string()), pa.array([v if not kind else 0 for v in n[kind].values()], pa.int64()),
                     pa.array([v if kind else 0 for v in n[kind].values()], pa.int64())], names=["w", "clean", "toxic"])

        n = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                n[toxic].update(_words_of(text.as_py()))
                n[toxic][""] += 1
                if len(n[0]) + len(n[1]) > COUNTED_WORDS:
                    yield from flush(n)
                    n = (Counter(), Counter())
        yield from flush(n)

    table = (sample.mapInArrow(counts, "w string, clean long, toxic long").groupBy("w")
                   .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    table = stage(table.where(F.col("toxic") >= MIN_ROWS), "toxic_words")
    size = table.where("w = ''").first()
    if size is None or not size["clean"] or not size["toxic"]:
        return Model({})
    nc, nt = size["clean"], size["toxic"]
    score = (F.log((F.col("toxic") + 0.5) / (nt + 1)) - F.log((F.col("clean") + 0.5) / (nc + 1)))
    top = (table.where("w <> ''").withColumn("s", score).where(F.col("s") >= MIN_LOG_ODDS)
                .orderBy(F.col("s").desc(), "w").limit(LEXICON).collect())
    # A stem stands only where it gathers what no single one of its words does.
    words = [(r["w"], r["toxic"]) for r in top if not r["w"].endswith("*")]
    single = lambda r: any(w.startswith(r["w"][:-1]) and 4 * n >= 3 * r["toxic"] for w, n in words)
    lexicon = {r["w"]: round(min(6.0, r["s"]), 9) for r in top
               if not (r["w"].endswith("*") and single(r))}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            x = np.array([grammar.features(t.as_py()) for t in batch.column(0)], dtype=np.float64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(3)), batch.column(1)], names=["a", "b", "c", "y"])

    got = np.array(sample.mapInArrow(features, "a double, b double, c double, y int").collect(), dtype=np.float64)
    return Model(lexicon, fit(got[:, :3], got[:, 3]))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, rows in a fixed order so that reruns agree."""
    order = np.lexsort((y, *x.T))
    x, y = np.column_stack([np.ones(len(x)), x])[order], y[order]
    w = np.zeros(x.shape[1])
    keep = np.diag([0.0, *[ridge] * (x.shape[1] - 1)]) * len(y) / 100
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep + 1e-6 * np.eye(len(w)), x.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(round(float(v), 9) for v in w)


def _scores(model: Model, texts: pa.Array) -> list[float]:
    grammar = Grammar(model.lexicon)
    b0, b1, b2, b3 = model.coefficients
    out = []
    for t in texts:
        x, y, z = grammar.features(t.as_py())
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, b0 + b1 * x + b2 * y + b3 * z)))))
    return out


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per row of ``docs``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_scores(model, batch.column(2)), pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
                .mapInArrow(task, "doc_id long, held_out boolean, score double")
                .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (its own columns) without the rows that score 0.5 or more."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s < 0.5 for s in _scores(model, batch.column(at))], pa.bool_()))

    return docs.mapInArrow(task, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return score_documents(docs, train(docs, labels, rows))
