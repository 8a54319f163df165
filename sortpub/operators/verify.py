"""Full-table checks of a published output: order, conservation, domain rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortpub.domains import ADDRESS_LEN, CONTINENTS, ID_MAX, ID_MIN, NAME_LEN
from sortpub.functions.text import comma_count
from sortpub.schema import RECORD_COLUMNS, serialize

BLOCK = 100_000


def _key(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def check_sorted(df: DataFrame, key: list[str] | str, offset: str = "offset", block: int = BLOCK) -> DataFrame:
    """is ``df`` in ``key`` order along ``offset``, with offsets 0..N-1 exactly once?

    One pass: rows are cut into blocks of ``block`` offsets, and a block's first row goes to
    the block before as well, where it closes the last step.  ``lag`` runs inside a block (a window
    partition holds at most ``block`` + 1 distinct offsets).
    """
    cols = [key] if isinstance(key, str) else list(key)
    own = F.expr(f"`{offset}` div {block}")
    both = F.when((F.col(offset) % block == 0) & (F.col(offset) > 0), F.array(own, own - 1)).otherwise(F.array(own))
    rows = df.select(F.col(offset).alias("_o"), _key(cols).alias("_k"), own.alias("_own"), F.explode(both).alias("_blk"))
    w = Window.partitionBy("_blk").orderBy("_o")
    steps = rows.select("_o", (F.col("_own") == F.col("_blk")).alias("_real"), "_k",
                        F.lag("_k").over(w).alias("_prev_k"), F.lag("_o").over(w).alias("_prev_o"))
    out = steps.agg(
        F.count_if("_real").alias("rows"),
        F.count_if(F.col("_prev_k") > F.col("_k")).alias("out_of_order"),
        F.count_if(F.col("_o") - F.col("_prev_o") != 1).alias("_steps"),
        F.min("_o").alias("_min"), F.max("_o").alias("_max"),
    )
    gaps = F.coalesce((F.col("_steps") > 0) | (F.col("_min") != 0) | (F.col("_max") != F.col("rows") - 1), F.lit(False))
    return out.select("rows", "out_of_order", gaps.alias("position_gaps"),
                      ((F.col("out_of_order") == 0) & ~gaps).alias("sorted"))


def check_conserved(before: DataFrame, after: DataFrame, cols: list[str] | None = None,
                    exact: bool = True) -> DataFrame:
    """nothing lost or invented between two tables (as multisets of rows).

    ``exact``: count every distinct row on both sides in one aggregation (map-side
    partial counts shrink a group of identical copies to one row before the shuffle).
    Otherwise only counts and an order-free fingerprint are compared (no shuffle).
    """
    cols = cols or [c for c in before.columns if c in after.columns]
    tagged = (before.select(*cols).withColumn("_side", F.lit(0))
              .unionByName(after.select(*cols).withColumn("_side", F.lit(1))))
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    if not exact:
        return tagged.agg(
            F.count_if(F.col("_side") == 0).alias("rows_in"),
            F.count_if(F.col("_side") == 1).alias("rows_out"),
            (F.coalesce(F.sum(F.when(F.col("_side") == 0, h)), F.lit(0))
             == F.coalesce(F.sum(F.when(F.col("_side") == 1, h)), F.lit(0))).alias("fingerprint_equal"),
        )
    per_row = tagged.groupBy(*cols).agg(
        F.count_if(F.col("_side") == 0).alias("_a"),
        F.count_if(F.col("_side") == 1).alias("_b"),
    )
    return per_row.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum(F.greatest(F.col("_a") - F.col("_b"), F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(F.col("_b") - F.col("_a"), F.lit(0))), F.lit(0)).alias("extra"),
        (F.coalesce(F.sum(h * F.col("_a")), F.lit(0)) == F.coalesce(F.sum(h * F.col("_b")), F.lit(0))
         ).alias("fingerprint_equal"),
    )


def domain_rules() -> dict[str, Column]:
    """Rule name -> predicate that holds for a record inside the generator's domains."""
    name, addr = F.col("name"), F.col("address")
    return {
        "id_range": F.col("id").between(ID_MIN, ID_MAX - 1),
        "name_length": F.length(name).between(*NAME_LEN),
        "name_letters": name.rlike(r"^[A-Za-z]+\z"),
        "address_length": F.length(addr).between(*ADDRESS_LEN),
        "address_digit_first": F.substring(addr, 1, 1).rlike(r"^[0-9]\z"),
        "address_space_third": F.substring(addr, 3, 1) == F.lit(" "),
        "address_chars": addr.rlike(r"^[A-Za-z0-9 ]+\z"),
        "continent_known": F.col("continent").isin(*CONTINENTS),
        "four_fields": comma_count(serialize(RECORD_COLUMNS)) == 3,
    }


def check_domains(df: DataFrame) -> DataFrame:
    """one pass, one violation counter per rule; result rows (rule, violations)."""
    rules = domain_rules()
    agg = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return agg.selectExpr(f"stack({len(rules)}, {stack}) as (rule, violations)")
