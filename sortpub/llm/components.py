"""Connected components of a link table by repeated minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortpub.session import stage


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """Links (u, v) -> (c, comp): the smallest id reachable, for every id that has a link.

    Each round takes the minimum over the neighbours, then jumps to the label's label, so paths
    shrink by halves; the table is staged between rounds.  Only a count reaches the driver.
    Rounds end when no label changes; running out of ``rounds`` (a path of 2**64 links) raises.
    """
    both = stage(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
                      .where("u <> v").distinct(), "links")
    labels = stage(both.groupBy(F.col("u").alias("c")).agg(F.least(F.col("c"), F.min("v")).alias("comp")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both.v == labels.c).groupBy(F.col("u").alias("n")).agg(F.min("comp").alias("_near"))
        step = labels.join(near, labels.c == near.n, "left").select(
            "c", F.col("comp").alias("_old"), F.least("comp", "_near").alias("comp"))
        jump = labels.select(F.col("c").alias("_c"), F.col("comp").alias("_far"))
        after = step.join(jump, step.comp == jump._c, "left").select("c", "_old", F.least("comp", "_far").alias("comp"))
        after = stage(after, "labels")
        changed = after.where("comp <> _old").count()
        labels = after.select("c", "comp")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
