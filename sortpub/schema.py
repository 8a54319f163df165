"""Record schema, sort-key registry and wire form of the person record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record: four columns, 32-bit signed id, no nulls once parsed.
PERSON = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("continent", T.StringType(), False),
    ]
)
RECORD_COLUMNS = [f.name for f in PERSON.fields]

# Fixed values of the wire form: header line and field separator.
HEADER = "id,name,address,continent"
SEPARATOR = ","

# Sort keys of the person record; any other column of a frame may also be used.
SORT_KEYS = ("id", "name", "continent")

# Columns that carry a record's position in its source topic; used as the last
# tie-break so that identical copies still have a repeatable, splittable order.
SOURCE_POSITION = ("partition", "offset")


def check_key(df: DataFrame, key: str) -> str:
    """Validate a sort key before any job starts (unknown key is an error)."""
    if key not in df.columns:
        raise ValueError(f"unknown sort key {key!r}; columns are {df.columns}")
    return key


def sort_columns(df: DataFrame, key: str, columns: list[str] | None = None,
                 tiebreak: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Key first, then every other record column, then the tie-break columns."""
    check_key(df, key)
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in tiebreak]
    rest = [c for c in cols if c != key]
    return [key, *rest, *[t for t in tiebreak if t in df.columns]]


def serialize(df_cols: list[str] | None = None) -> Column:
    """Record → ``id,name,address,continent`` (no quoting, no escaping)."""
    cols = df_cols or RECORD_COLUMNS
    return F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in cols])


def key_text(key: str) -> Column:
    """A record's key as text."""
    return F.col(key).cast("string")
