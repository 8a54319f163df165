"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``r = target / source size`` times.  Within its source
the documents stand in order of size; the prefix sum of the expected copies, shifted by one
random offset per source, is cut at the integers, and a document is emitted once per integer
it crosses.  Neighbours in that order have nearly equal sizes, so a source's taken words
come within about its longest document of the target.

Null text has size 0; a null source is a source of its own and comes last; rows that are
repeated are sampled each on its own; a null doc_id sorts first among equals; an empty table
gives an empty result; further columns are carried by ``mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.operators.position import with_position
from sortpub.session import stage

# Fixed values of the contract: weights by source rank, share of all sizes, cap on a target.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random offset in [0, 1), the same on every run."""
    text = F.concat(F.lit(seed + "|"), F.coalesce(source, F.lit("<null>")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: int = CAP) -> DataFrame:
    """(_source, source_size) -> + target.  ``share`` of the total goes out by weight; a target
    stops at ``cap`` times its source, what is over is shared again until none is above.

    Each round is one aggregate over the table of sources; only four sums reach the driver.
    """
    ranked = with_position(sizes, [F.col("_source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    table = stage(ranked.withColumn("_w", weight), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, held = 0.0, -1
    while True:
        over = (F.lit(level) * F.col("_w") > cap * F.col("source_size")) if held >= 0 else F.lit(False)
        n, full, free = table.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("_w"))), F.lit(0))).first()
        if n == held or not free:
            break
        level, held = (share * total - float(cap * full)) / free, n
    target = F.least(F.lit(float(cap)) * F.col("source_size"), F.lit(level) * F.col("_w"))
    return table.withColumn("target", target.cast("double")).drop("_w", "_rank")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP,
        seed: str = SEED, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (all, if None) in a struct ``row``, with size, source_size, target, copies."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
                       F.col("doc_id").cast("long").alias("_id"), F.col("source").cast("string").alias("_source"),
                       word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_tie"))
    ranked = with_position(rows, [F.col("_source").asc_nulls_last(), F.col("size"), F.col("_id"), F.col("_tie")], "_at")
    sizes = ranked.groupBy("_source").agg(F.sum("size").alias("source_size"), F.min("_at").alias("_from"))
    sources = source_targets(sizes, weights, share, cap).withColumnRenamed("_source", "_s")
    both = ranked.join(sources, F.col("_source").eqNullSafe(F.col("_s")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("_at") - F.col("_from")
    shift = offset(F.col("_source"), seed)
    copies = F.least(F.floor(shift + (at + 1) * F.col("_rate")) - F.floor(shift + at * F.col("_rate")), F.lit(cap))
    return (both.withColumn("_rate", rate).withColumn("copies", copies.cast("long"))
                .select("row", "size", "source_size", "target", "copies"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    out = mix(docs, carry=["doc_id"])
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns."""
    out = mix(docs, **how).where(F.col("copies") > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS at FROM sized),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM sized GROUP BY source),
steps AS (
  SELECT source, source_size, w,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - 2 * coalesce(sum(source_size) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM src),
lvl AS (SELECT min_by(level, 2 * source_size / w) AS level FROM steps WHERE level * w <= 2 * source_size),
tgt AS (SELECT s.source, s.source_size, least(2.0::DOUBLE * s.source_size, l.level * s.w) AS target FROM src s, lvl l),
rate AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r,
         ('0x' || substr(md5('{SEED}|' || coalesce(source, '<null>')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM tgt)
SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
  CAST(least(floor(t.u + (d.at + 1) * t.r) - floor(t.u + d.at * t.r), 2) AS BIGINT) * d.size AS taken
FROM ranked d JOIN rate t ON d.source IS NOT DISTINCT FROM t.source
"""
