"""Text expressions of the line format: trim, line filter, split, strict integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space set trimmed from lines and fields
# (tab, LF, VT, FF, CR, space, NEL, NBSP, OGHAM SPACE MARK, U+2000..U+200A,
# LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATH SPACE,
# IDEOGRAPHIC SPACE).
WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)

# A field holding an integer: optional sign, then decimal digits only.
INT_PATTERN = r"^[+-]?[0-9]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip Unicode white space at both ends (Spark's plain trim strips only U+0020)."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def comma_count(c: Column | str) -> Column:
    v = _col(c)
    return F.length(v) - F.length(F.replace(v, F.lit(","), F.lit("")))


def keep_line(c: Column | str) -> Column:
    """Line filter of the publisher: non-empty after trim and at least three commas.

    A line with three commas is never blank after trimming (a comma is not white
    space), so the comma test alone decides: at least three commas <=> the 4-limited
    split has 4 parts.  The value is referenced once, so a filter pushed into an
    upstream projection evaluates that projection once.
    """
    return F.size(split_fields(c, 4)) == 4


def split_fields(c: Column | str, limit: int = 4) -> Column:
    """Split on commas into at most ``limit`` fields; the last keeps further commas."""
    return F.split(_col(c), ",", limit)


def strict_int(c: Column | str) -> Column:
    """32-bit integer or null: sign and digits only, in range (no '3.14', '1e3', '1_0')."""
    v = _col(c)
    return F.when(v.rlike(INT_PATTERN), v.try_cast("int"))


def bucket_label(c: Column | str) -> Column:
    """Display label of a bucket: spaces become underscores (display only)."""
    return F.replace(_col(c), F.lit(" "), F.lit("_"))
