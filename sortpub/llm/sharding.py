"""Balanced label propagation: linked documents move to their neighbours' shards under quotas.

Documents of equal text are linked.  Members of one group in one shard are interchangeable, so
the labels live in a table (group, shard, members): a group of any size is at most one row per
shard.  Each round, a group's members wish to move to the shard that holds most of the group.  The
wishes are summed by pair of shards; chains into free seats and circles of wishes, in which a shard's
departures are room for its arrivals, are granted, first the wishes that save most links.  Documents without links cut nothing; they fill the shards at the end, so
that the counts of rows differ by one at most (law ``rows``).

Null text counts no bytes, has the checksum of no bytes, and is linked with empty text; repeated
rows are rows of their own; a null doc_id sorts first; an empty table gives no rows; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortpub.llm.ranking import running_total
from sortpub.operators.position import with_position
from sortpub.session import stage

SHARDS = 24
STILL = 4                # rounds in turn without a move that end the propagation
GROUP = ["_g1", "_g2"]


def _by_shard(values: list[int], shard: Column) -> Column:
    """values[shard]; one value per shard, so the literal is as long as there are shards."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), shard.cast("int") + 1)


def _loads(labels: DataFrame, shards: int) -> list[int]:
    got = {r["_shard"]: r["_n"] for r in labels.groupBy("_shard").agg(F.sum("_n").alias("_n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _flow(forced: dict[tuple[int, int], int], ties: dict[tuple[int, int], int],
          free: list[int]) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], int]]:
    """Wishes (from, to) -> rows, tied wishes (low, high) -> rows that may go either way: what is
    granted of both, by (from, to).  A shard's departures are room for arrivals: no shard gets more
    rows than it loses and has free.

    Chains end in free seats; then circles of wishes are granted until none is left.  All tables are
    (shard, shard), whatever the number of rows.
    """
    shards = range(len(free))
    forced, ties, free = dict(forced), dict(ties), list(free)
    by_wish: dict[tuple[int, int], int] = {}
    by_tie: dict[tuple[int, int], int] = {}

    def cap(a: int, b: int) -> int:
        return forced.get((a, b), 0) + ties.get((min(a, b), max(a, b)), 0)

    def grant(a: int, b: int, k: int) -> None:
        wish = min(k, forced.get((a, b), 0))
        if wish:
            forced[a, b] -= wish
            by_wish[a, b] = by_wish.get((a, b), 0) + wish
        if k > wish:
            ties[min(a, b), max(a, b)] -= k - wish
            by_tie[a, b] = by_tie.get((a, b), 0) + k - wish

    open_ = [s for s in shards if free[s] > 0]
    while open_:
        b = open_.pop()
        for a in shards:
            k = min(cap(a, b), free[b]) if a != b else 0
            if k > 0:
                grant(a, b, k)
                free[b] -= k
                free[a] += k
                open_.append(a)
    for a in shards:                                 # circles of two: the tied wishes are halved between them
        for b in range(a + 1, len(free)):
            there, back, both = forced.get((a, b), 0), forced.get((b, a), 0), ties.get((a, b), 0)
            k = min(there + both, back + both, (there + back + both) // 2)
            grant(a, b, k), grant(b, a, k)
    for a in shards:
        for b in shards:
            while a != b and cap(a, b) > 0:
                came, line = {b: b}, [b]             # the shortest way back from b to a, not by the wish itself
                for x in line:
                    for y in shards:
                        if y not in came and (x, y) != (b, a) and cap(x, y) > 0:
                            came[y] = x
                            line.append(y)
                if a not in came:
                    break
                way = [a]
                while way[-1] != b:
                    way.append(came[way[-1]])
                steps = [(a, b), *zip(way[:0:-1], way[-2::-1])]
                k = min(cap(*step) for step in steps)
                for step in steps:
                    grant(*step, k)
    return by_wish, by_tie


def _by_pair(granted: dict[tuple[int, int], int], shards: int, a: Column, b: Column) -> Column:
    """granted[a, b], or 0; one value per pair of shards."""
    return F.element_at(F.array(*[F.lit(granted.get((i, j), 0)).cast("long") for i in range(shards) for j in range(shards)]),
                        (a * shards + b + 1).cast("int"))


def _round(labels: DataFrame, free: list[int], shards: int, seed: int, only_free: bool) -> DataFrame:
    """Labels after one round.  A group's members wish to be in the shard that holds most of it
    (``only_free``: of the shards with a free seat); of two that hold most, either may be left for
    the other."""
    tie = F.xxhash64(F.lit(seed), *GROUP, "_shard")
    rank = F.struct(F.col("_n").alias("n"), tie.alias("tie"), F.col("_shard").alias("s"))
    may = _by_shard(free, F.col("_shard")) > 0 if only_free else F.lit(True)
    best = labels.groupBy(*GROUP).agg(F.max(F.when(may, rank)).alias("_best"))
    rows = labels.withColumn("_own", rank).join(best, GROUP).where(
        F.col("_best").isNotNull() & (F.col("_best") > F.col("_own")))
    if only_free:
        wants = rows.withColumn("_tied", F.lit(False))
    else:                                            # one tied shard of a group may go either way
        second = rows.groupBy(*GROUP).agg(F.max("_own").alias("_second"))
        wants = rows.join(second, GROUP).withColumn(
            "_tied", (F.col("_own") == F.col("_second")) & (F.col("_own.n") == F.col("_best.n")))
    s, to = F.col("_shard"), F.col("_best.s")
    wants = stage(wants.select(
        *GROUP, "_tied", F.when(F.col("_tied"), F.least(s, to)).otherwise(s).alias("_from"),
        F.when(F.col("_tied"), F.greatest(s, to)).otherwise(to).alias("_to"), F.col("_best.n").alias("_gain"), "_n"), "wants")
    sums = wants.groupBy("_tied", "_from", "_to").agg(F.sum("_n").alias("_n")).collect()     # two rows per pair of shards at most
    by_wish, by_tie = _flow({(r["_from"], r["_to"]): r["_n"] for r in sums if not r["_tied"]},
                            {(r["_from"], r["_to"]): r["_n"] for r in sums if r["_tied"]}, free)
    if not by_wish and not by_tie:
        return labels
    ranked = running_total(wants, ["_tied", "_from", "_to", F.col("_gain").desc(), *GROUP], "_n", "_before")
    starts = ranked.groupBy("_tied", "_from", "_to").agg(F.min("_before").alias("_start"))   # as many
    a, b = F.col("_from"), F.col("_to")
    at = F.col("_before") - F.col("_start")
    there = F.when(F.col("_tied"), _by_pair(by_tie, shards, a, b)).otherwise(_by_pair(by_wish, shards, a, b))
    back = F.when(F.col("_tied"), _by_pair(by_tie, shards, b, a)).otherwise(F.lit(0))
    # Of a group's rows [at, at + n): those before ``there`` go on, the next ``back`` go the other way.
    upto = lambda edge: F.greatest(F.lit(0), F.least(F.col("_n"), edge - at))
    moves = (ranked.join(F.broadcast(starts), ["_tied", "_from", "_to"])
                   .withColumn("_k", (2 * upto(there) - upto(there + back)).cast("long")).where("_k <> 0"))
    moves = stage(moves.select(*GROUP, "_from", "_to", "_k"), "moves")
    parts = [labels, moves.select(*GROUP, F.col("_to").alias("_shard"), F.col("_k").alias("_n")),
             moves.select(*GROUP, F.col("_from").alias("_shard"), (-F.col("_k")).alias("_n"))]
    after = (reduce(DataFrame.unionByName, parts).groupBy(*GROUP, "_shard").agg(F.sum("_n").alias("_n"))
             .where("_n > 0"))
    return stage(after, "labels")


def propagate(groups: DataFrame, quotas: list[int], rounds: int | None = None) -> DataFrame:
    """Groups (_g1, _g2, _start, _n) of linked rows -> labels (_g1, _g2, _shard, _n).

    The first labels go round robin over the rows' numbers, so they are even.  Rounds stop when no
    group is cut, or when ``STILL`` rounds in turn (both kinds, with other ties) have moved nothing.
    They end: each move raises the sum of the squared counts, which the groups bound.  ``rounds``
    may end them before (a label set is valid after any round).
    """
    shards = len(quotas)
    s = F.col("_shard")
    upto = lambda at: F.floor((at - s + shards) / F.lit(shards))  # noqa: E731 - rows of shard s before number ``at``
    labels = stage(
        groups.select(*GROUP, "_start", F.col("_n").alias("_all"),
                      F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"))
              .withColumn("_n", (upto(F.col("_start") + F.col("_all") - 1) - upto(F.col("_start") - 1)).cast("long"))
              .where("_n > 0").select(*GROUP, "_shard", "_n"), "labels")
    whole = groups.count()
    done, still, before = 0, 0, None
    while rounds is None or done < rounds:
        sums = labels.groupBy("_shard").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"),
                                            F.sum(F.col("_n").cast("decimal(38,0)") * F.col("_n")).alias("sq")).collect()
        got = {r["_shard"]: r["n"] for r in sums}
        if sum(r["k"] for r in sums) == whole:       # no group is cut
            break
        square = sum(r["sq"] for r in sums)
        still = still + 1 if square == before else 0
        if still == STILL:
            break
        free = [max(0, q - got.get(i, 0)) for i, q in enumerate(quotas)]
        labels = _round(labels, free, shards, done, only_free=still % 2 == 1)
        done, before = done + 1, square
    return labels


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("_g1"), F.xxhash64(F.lit(1), text).alias("_g2"))
    rows = with_position(rows, [*GROUP, "doc_id"], "_at")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = rows.groupBy(*GROUP).agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    groups = stage(groups, "groups")
    labels = propagate(groups, quotas, rounds)

    # Slots of the labelled members; what a shard can't take (only if nearly all rows are
    # linked) is dealt out with the documents without links.
    placed = running_total(labels, ["_shard", F.col("_n").desc(), *GROUP], "_n", "_before")
    starts = placed.groupBy("_shard").agg(F.min("_before").alias("_from"))   # one row per shard
    placed = (placed.join(F.broadcast(starts), "_shard")
                    .withColumn("_slot", F.col("_before") - F.col("_from"))
                    .withColumn("_keep", F.greatest(F.lit(0), F.least(F.col("_n"), _by_shard(quotas, F.col("_shard")) - F.col("_slot"))))
                    .where("_keep > 0"))
    placed = stage(placed.select(*GROUP, "_shard", "_slot", F.col("_keep").cast("long").alias("_n")), "placed")
    taken = _loads(placed, shards)
    before = Window.partitionBy(*GROUP).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)  # <= shards rows
    seats = (placed.withColumn("_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                   .groupBy(*GROUP).agg(F.collect_list(F.struct("_lo", "_n", "_shard", "_slot")).alias("_seats"))
                   .join(groups.select(*GROUP, "_start"), GROUP))
    number = F.col("_at") - F.col("_start")
    mine = F.get(F.filter("_seats", lambda x: (number >= x["_lo"]) & (number < x["_lo"] + x["_n"])), 0)
    seated = stage(rows.join(seats, GROUP, "left").withColumn("_seat", mine)
                   .withColumn("_slot", F.col("_seat._slot") + number - F.col("_seat._lo"))
                   .select("doc_id", "size", "text_crc32", "_at", F.col("_seat._shard").alias("_shard"), "_slot"), "seated")

    rest = with_position(seated.where("_shard is null"), ["_at"], "_rest")
    room = [q - n for q, n in zip(quotas, taken)]
    edges = [sum(room[:s]) for s in range(shards)]
    pick = F.lit(0)
    for s in range(1, shards):
        pick = F.when(F.col("_rest") >= edges[s], F.lit(s)).otherwise(pick)
    fill = rest.withColumn("_shard", pick).withColumn(
        "_slot", F.col("_rest") - _by_shard(edges, F.col("_shard")) + _by_shard(taken, F.col("_shard")))
    out = seated.where("_shard is not null").unionByName(fill.drop("_rest"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                      F.col("_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
