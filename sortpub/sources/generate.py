"""Seeded synthetic person records.

Draws are counter-based: word j of a record is Spark's ``xxhash64`` of (seed, row key, j), cut to 63 bits, so
the same key gives the same record whatever the partitioning, and other engines can recompute it.  A
word is a number whose digits are choices: in base 52 a letter each, two at a time by a table of
pairs.  Five words make a record, all in generated code without string digests or higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.domains import (ADDRESS_LEN, ALNUM_SPACE, CONTINENTS, DIGITS, ID_MAX, LETTERS, NAME_LEN)

PER_WORD = 10           # characters of one word: 63 ** 10 < 2 ** 60
# What stands between the entries of a table (no character of a domain).
GAP = "\u0001"


def word(key: Column, j: int, seed: int) -> Column:
    """63 bits that follow from the seed, the row's key and the counter."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), key.cast("long"), F.lit(j).cast("long")), 1)


def digit(w: Column, below: int, base: int) -> Column:
    """The choice of ``base`` that stands above choices of ``below`` combinations."""
    return (F.call_function("div", w, F.lit(below)) if below > 1 else w) % F.lit(base)


def table_of(entries: list[str]) -> Column:
    """A constant array (one literal, split when the plan is made)."""
    return F.split(F.lit(GAP.join(entries)), GAP)


def pick(w: Column, below: int, entries: list[str]) -> Column:
    """One of ``entries``."""
    return F.get(table_of(entries), digit(w, below, len(entries)).cast("int"))


def characters(words: list[Column], charset: str, n: int) -> Column:
    """``n`` (even) characters of ``charset``, two at a time, ``PER_WORD`` from a word."""
    pairs = [a + b for a in charset for b in charset]
    return F.concat(*[pick(words[i // PER_WORD], len(charset) ** (i % PER_WORD), pairs) for i in range(0, n, 2)])


def random_int(key: Column, j: int, bound: int, seed: int) -> Column:
    """Integer in [0, bound), from word ``j``."""
    return digit(word(key, j, seed), 1, bound)


def choice(key: Column, j: int, values: tuple[str, ...], seed: int) -> Column:
    """One of ``values``, from word ``j``."""
    return pick(word(key, j, seed), 1, list(values))


def random_string(key: Column, j: int, charset: str, min_len: int, max_len: int, seed: int) -> Column:
    """String of length in [min_len, max_len] over ``charset``: word ``j`` gives the length, those behind the text."""
    words = [word(key, j + 1 + i, seed) for i in range(-(-max_len // PER_WORD))]
    size = (digit(word(key, j, seed), 1, max_len - min_len + 1) + min_len).cast("int")
    return F.substr(characters(words, charset, max_len + max_len % 2), F.lit(1), size)


# The choices of word 0, from the lowest: (name, combinations below, base).
_SPANS = [("id", ID_MAX), ("continent", len(CONTINENTS)), ("name", NAME_LEN[1] - NAME_LEN[0] + 1), ("address", ADDRESS_LEN[1] - ADDRESS_LEN[0] + 1), ("digit", len(DIGITS))]
CHOICES: dict[str, tuple[int, int]] = {}
_below = 1
for _name, _base in _SPANS:
    CHOICES[_name] = (_below, _base)
    _below *= _base
WORDS = 5               # choices, two of the name, two of the address


def with_person(df: DataFrame, key: str, seed: int) -> DataFrame:
    """(key, id, name, address, continent) drawn from ``key``; an address has a digit first and a space third."""
    drawn = df.select(F.col(key).alias("_key"), *[word(F.col(key), j, seed).alias(f"_w{j}") for j in range(WORDS)])
    own = F.col("_w0")
    size = lambda name, lo: (digit(own, *CHOICES[name]) + lo).cast("int")
    name = characters([F.col("_w1"), F.col("_w2")], LETTERS, NAME_LEN[1] + NAME_LEN[1] % 2)
    text = drawn.select("*", characters([F.col("_w3"), F.col("_w4")], ALNUM_SPACE, ADDRESS_LEN[1]).alias("_text"))
    first = pick(own, CHOICES["digit"][0], list(DIGITS))
    address = F.concat(first, F.substring("_text", 2, 1), F.lit(" "), F.substr(F.col("_text"), F.lit(4), size("address", ADDRESS_LEN[0]) - 3))
    return text.select(
        F.col("_key").alias(key), digit(own, *CHOICES["id"]).cast("int").alias("id"),
        F.substr(name, F.lit(1), size("name", NAME_LEN[0])).alias("name"),
        address.alias("address"),
        pick(own, CHOICES["continent"][0], list(CONTINENTS)).alias("continent"))


def generate_people(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """A1: ``n`` records; ids repeat, as draws are with replacement."""
    rows = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    return with_person(rows.withColumnRenamed("id", "_row"), "_row", seed).drop("_row")


def generate_for(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A1 for the rows of another table: one record per row, drawn from its ``key``."""
    return with_person(df, key, seed)
