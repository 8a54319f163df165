"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from sortpub.functions.text import (  # noqa: F401
    WHITESPACE,
    bucket_label,
    comma_count,
    keep_line,
    split_fields,
    strict_int,
    trim_ws,
)
