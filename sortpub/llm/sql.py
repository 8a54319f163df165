"""Pieces of DuckDB SQL that several operators' oracles share."""

from __future__ import annotations

# Fixed value: the reversed polynomial of CRC-32.
CRC_POLYNOMIAL = 3988292384
ALL_ONES = 4294967295


def utf8(text: str) -> str:
    """The UTF-8 bytes of an expression whose code points are below U+0800, as a list."""
    return (f"flatten(list_transform(regexp_extract_all({text}, '(?s).'), lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::BIGINT] "
            "ELSE [192 + (ord(ch) >> 6)::BIGINT, 128 + (ord(ch) & 63)::BIGINT] END))")


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of an expression (code points below U+0800)."""
    return (f"xor(list_reduce([{ALL_ONES}::BIGINT] || {utf8(text)}, lambda c, b: list_reduce([xor(c, b)] || range(1, 9), "
            f"lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, {CRC_POLYNOMIAL}::BIGINT) ELSE r >> 1 END)), {ALL_ONES}::BIGINT)")
