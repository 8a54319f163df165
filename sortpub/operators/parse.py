"""Lines → records, with a reject table (one projection, two filters)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortpub.functions.text import keep_line, split_fields, strict_int, trim_ws
from sortpub.schema import RECORD_COLUMNS

# Reject reasons.
FEW_FIELDS = "few_fields"
BAD_ID = "bad_id"


# Verdicts of the line filter.
KEEP, BLANK, FEW = "keep", "blank", "few"


def judge_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Every line trimmed, with ``_verdict``: keep, blank (or null), or few (fields).

    Two projections, trim and verdict: the verdict takes the trimmed value twice, which the optimizer doesn't inline.
    """
    others = [c for c in df.columns if c != value]
    trimmed = df.select(*others, trim_ws(value).alias(value))
    few = F.when(F.length(value) > 0, F.lit(FEW)).otherwise(F.lit(BLANK))
    return trimmed.select(*others, value, F.when(keep_line(value), F.lit(KEEP)).otherwise(few).alias("_verdict"))


def kept(judged: DataFrame) -> DataFrame:
    """The lines to keep.  A generator, not a filter: a filter would be pushed below the verdict's
    projections and compute them, and the line, a second time."""
    others = [c for c in judged.columns if c != "_verdict"]
    return judged.select(F.explode(F.when(F.col("_verdict") == KEEP, F.array(F.struct(*others)))).alias("_r")).select("_r.*")


def filter_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Publisher's line filter: keep non-blank lines with >= 3 commas, trimmed; a line is computed once."""
    return kept(judge_lines(df, value)).select(*df.columns)


def parse(df: DataFrame, value: str = "value", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Parse every line once; ``keep`` carries source columns (e.g. partition, offset).

    Three projections: split; trimmed fields; id.  A non-cheap expression used twice
    is not re-inlined by the optimizer, so split, the id trim and the integer check
    each run once per line.
    """
    carry = [*keep, value]
    split = df.select(*carry, split_fields(value, 4).alias("_parts"))
    enough = F.size("_parts") == 4
    fields = split.select(*carry, enough.alias("_ok"),
                          *[trim_ws(F.get("_parts", i)).alias(f"_f{i}") for i in range(4)])
    ided = fields.select(*carry, "_ok", "_f1", "_f2", "_f3",
                         F.when(F.col("_ok"), strict_int("_f0")).alias("_id"))
    reason = F.when(~F.col("_ok"), F.lit(FEW_FIELDS)).when(F.col("_id").isNull(), F.lit(BAD_ID))
    return ided.select(
        *carry,
        F.col("_id").alias("id"),
        F.when(F.col("_ok"), F.col("_f1")).alias("name"),
        F.when(F.col("_ok"), F.col("_f2")).alias("address"),
        F.when(F.col("_ok"), F.col("_f3")).alias("continent"),
        reason.alias("reject_reason"),
    )


def _route(parsed: DataFrame, cond: Column, keep: list[str], cols: list[str]) -> DataFrame:
    """Rows where ``cond`` holds, as ``explode`` of a 0/1-element array.

    A plain filter on ``reject_reason`` is pushed below the parse projections and
    re-inlines them (the parse runs twice per line); a generator is not, so the parse
    runs once.  ``keep`` columns ride beside the generator, so filters on them (e.g. a
    head sample on partition/offset) still reach the scan.
    """
    return (parsed.select(*keep, F.explode(F.when(cond, F.array(F.struct(*cols)))).alias("_r"))
                  .select(*keep, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def valid(parsed: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Records that parsed: non-null id and four fields."""
    return _route(parsed, F.col("reject_reason").isNull(), list(keep), list(RECORD_COLUMNS))


def rejects(parsed: DataFrame, keep: list[str] | tuple[str, ...] = (), value: str = "value") -> DataFrame:
    """Lines that did not parse, with the reason."""
    return _route(parsed, F.col("reject_reason").isNotNull(), list(keep), [value, "reject_reason"])
