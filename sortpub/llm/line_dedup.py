"""Line dedup by winnowing, in DataFrame functions only.

A run of at least ``min_lines`` consecutive lines that also starts earlier (smaller doc_id, or
the same document and an earlier line) is deleted; overlaps count, and lines are judged on the
input.  Winnowing picks the line of smallest hash in every window of ``min_lines`` lines, so
every such run holds a picked line at the same place in all its copies.  Picked lines that
occur at two places or more are joined back to their places; a match is extended both ways by
the windows of ``min_lines`` lines around it, and each window whose earliest start lies
elsewhere covers its lines.  A document of fewer lines that holds a word is one run: all of it is deleted if
an earlier document has the same text.

Groups are summed up before they are shuffled, and a window's earliest start is a minimum: a
line that stands in a third of all documents never makes pairs.

Null text is one empty line's absence: no lines, nothing removed.  A null doc_id sorts last.
Rows with the same doc_id and text are one document, judged alike.  Tables may be empty; other
columns are carried by ``drop_repeated_runs``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LINES = 3
PLACES = 16             # in which the copies of a short text meet their first
DOC = ["_d1", "_d2"]


def doc_key() -> list[Column]:
    """Order of documents: doc_id (null last), then the text's hash for repeated doc_ids."""
    last = F.lit((1 << 63) - 1)
    return [F.coalesce(F.col("doc_id").cast("long"), last).alias("_d1"),
            F.xxhash64("text", F.col("doc_id").isNull()).alias("_d2")]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def removed_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(_d1, _d2, _gone): line numbers (from 0) to delete, one row per document that loses any."""
    t = F.lit(min_lines)
    lines = (docs.where("text is not null").select(*doc_key(), split_lines(F.col("text")).alias("_l"))
                 .where(F.size("_l") >= t))
    hashed = lines.select(*DOC, "_l", F.transform("_l", lambda x: F.xxhash64(x)).alias("_h"))
    # Winnowing: the smallest hash of each window, the first of equals.
    windows = F.sequence(F.lit(0), F.size("_h") - t)
    least = F.transform(windows, lambda i: i + F.array_position(
        F.slice("_h", i + 1, t), F.array_min(F.slice("_h", i + 1, t))).cast("int") - 1)
    picked = hashed.select(*DOC, "_l", "_h", F.explode(F.array_distinct(least)).alias("_at"))
    # The windows that hold a picked line, as two hashes of their lines.
    starts = F.sequence(F.greatest(F.lit(0), F.col("_at") - t + 1), F.least(F.col("_at"), F.size("_h") - t))
    around = F.transform(starts, lambda s: F.struct(
        s.alias("s"), F.xxhash64(F.slice("_l", s + 1, t)).alias("w1"),
        F.xxhash64(F.lit(7), F.slice("_l", s + 1, t)).alias("w2")))
    prints = picked.select(*DOC, "_at", F.get("_h", F.col("_at")).alias("_f"), around.alias("_w"))
    repeated = prints.groupBy("_f").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_f")
    found = prints.join(repeated, "_f").select(*DOC, F.inline("_w"))
    earliest = (found.groupBy("w1", "w2").agg(F.min(F.struct(*DOC, "s")).alias("_first"), F.max(F.struct(*DOC, "s")).alias("_last"))
                     .where("_first < _last").drop("_last"))
    later = (found.join(earliest, ["w1", "w2"]).where(F.struct(*DOC, "s") > F.col("_first"))
                  .select(*DOC, "s").groupBy(*DOC).agg(F.collect_set("s").alias("_s")))
    gone = F.array_distinct(F.flatten(F.transform("_s", lambda s: F.sequence(s, s + t - 1))))
    return later.select(*DOC, gone.alias("_gone")).unionByName(_short_copies(docs, min_lines))


def _short_copies(docs: DataFrame, min_lines: int) -> DataFrame:
    """(_d1, _d2, _gone): all lines of documents with fewer than ``min_lines`` lines whose text stands earlier.

    The copies of one text are met by their first document in ``PLACES`` places.
    """
    short = (docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*doc_key(), split_lines(F.col("text")).alias("_l"))
                 .where(F.size("_l") < min_lines).select(*DOC, F.size("_l").alias("_k"), F.xxhash64("_l").alias("w1"), F.xxhash64(F.lit(7), "_l").alias("w2")))
    firsts = (short.groupBy("w1", "w2").agg(F.min(F.struct(*DOC)).alias("_first"), F.max(F.struct(*DOC)).alias("_last"))
                   .where("_first < _last").drop("_last")
                   .withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1)))))
    placed = short.withColumn("_place", F.pmod(F.xxhash64(*DOC), F.lit(PLACES)).cast("int"))
    copies = placed.join(firsts, ["w1", "w2", "_place"]).where(F.struct(*DOC) > F.col("_first"))
    return copies.select(*DOC, F.sequence(F.lit(0), F.col("_k") - 1).alias("_gone")).dropDuplicates(DOC)


def _kept(docs: DataFrame, min_lines: int, columns: list[Column]) -> DataFrame:
    body = docs.select(*columns, *doc_key(), split_lines(F.col("text")).alias("_l"))
    both = body.join(removed_lines(docs, min_lines), DOC, "left")
    flagged = F.transform("_l", lambda x, i: F.struct(x.alias("x"), F.array_contains("_gone", i).alias("g")))
    kept = F.when(F.col("_gone").isNull(), F.col("_l")).otherwise(
        F.transform(F.filter(flagged, lambda y: ~y["g"]), lambda y: y["x"]))
    return both.withColumn("_k", kept)


def drop_repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with its own columns, text without the runs that stand earlier."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    out = _kept(docs, min_lines, [row]).withColumn("_text", F.array_join("_k", "\n"))
    return out.select(*[F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def line_digest(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (kept lines joined by a line feed)."""
    out = _kept(docs, min_lines, [F.col("doc_id").cast("long").alias("doc_id")])
    n = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    return out.select("doc_id", n("_l").alias("n_lines"), (n("_l") - n("_k")).alias("n_removed"),
                      F.sha2(F.coalesce(F.array_join("_k", "\n"), F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS n, len(l) AS total
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
win AS (
  SELECT doc_id, n, total,
         {" || chr(10) || ".join(f"lead(line, {i}) OVER w" if i else "line" for i in range(MIN_LINES))} AS body
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
later AS (
  SELECT doc_id, n FROM (
    SELECT doc_id, n, row_number() OVER (PARTITION BY body ORDER BY doc_id, n) AS k
    FROM win WHERE n + {MIN_LINES} <= total) WHERE k > 1),
short AS (
  SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents
  WHERE regexp_matches(text, '[^\\x20\\x09-\\x0D]') AND len(string_split(text, chr(10))) < {MIN_LINES}),
gone AS (SELECT DISTINCT doc_id, n + i AS n FROM later, range({MIN_LINES}) r(i)
         UNION SELECT l.doc_id, l.n FROM lines l JOIN short ON l.doc_id = short.doc_id AND k > 1),
marked AS (
  SELECT l.doc_id, l.n, l.line, g.n IS NOT NULL AS g
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n),
sums AS (
  SELECT doc_id, count(*) AS n_lines, count_if(g) AS n_removed,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT g), '')) AS kept_sha256
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(s.kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN sums s USING (doc_id)
"""
