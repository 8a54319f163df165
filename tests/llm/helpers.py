"""Small tables with every awkward case, and brute-force versions to compare with."""

import re

from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_p", "_i", "_m", "row", "r", "d1", "keys", "size", "shard", "score", "rank", "copies", "c", "x", "n", "kept", "label")


def words(text):
    return WORD.findall((text or "").encode())


def prose(seed, n):
    """n words that follow from the seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("abcdefghij"[x >> k & 7] for k in (3, 7, 11, 15, 19)[:2 + x % 4]))
    return " ".join(out)


def docs_frame(spark, rows, clashes=True):
    """(doc_id, text[, source]) tuples as a documents table, with columns named like internals."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clashes:
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    return df


def awkward():
    """Nulls, empty, blank, one word, repeated rows, copies, near copies, shared passages, junk, long."""
    base, passage = prose(1, 300), prose(2, 80)
    near = base.split(" ")
    near[150] = "changed"
    rows = [
        (None, None), (None, base), (None, ""), (0, None), (1, ""), (2, " \t\n "), (3, "word"), (4, "four words only here"),
        (5, base), (6, base), (7, " ".join(near)), (7, " ".join(near)), (8, base.upper()), (9, "intro one\n" + passage + "\nend one"),
        (10, "other start\n\n" + passage + " tail ü ß   é"), (11, "ab" * 400), (12, "la " * 300), (13, "la " * 200), (13, "different text, same id"),
        (14, prose(3, 20000)), (15, "x " + prose(3, 20000)[5000:9000]), (16, "ü" * 120), (17, "ü" * 60 + "a" + "ü" * 130),
        (18, passage.replace(" ", "  ")), (-5, prose(4, 60)), (19, prose(4, 60)), (1 << 40, "far " + prose(4, 59)),
    ]
    return rows


def empty(spark):
    return docs_frame(spark, [(1, "a")]).where("false")
