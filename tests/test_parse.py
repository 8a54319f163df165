"""Line filter, split, trim, strict int, valid/reject routing (FIXTURES.md tables)."""

import pytest

from sortpub.operators import parse
from tests.conftest import lines_df

ACCEPTED = [
    ("318,Wilhelmina,77 Quay Rd,Europe", (318, "Wilhelmina", "77 Quay Rd", "Europe")),
    ("0,Zero,0 z,Asia", (0, "Zero", "0 z", "Asia")),
    ("-905,Minus,1 m,Africa", (-905, "Minus", "1 m", "Africa")),
    (" 12\t, Tab Name ,\t9 t , South America", (12, "Tab Name", "9 t", "South America")),
    ("3,C,1 a,b,c", (3, "C", "1 a", "b,c")),
    ("+7,Plus,1 a,Asia", (7, "Plus", "1 a", "Asia")),
    (" 　7\u0085,\tN , A\x0b,C ", (7, "N", "A", "C")),
    ('5,Quo"te,1 "x",Asia', (5, 'Quo"te', '1 "x"', "Asia")),
    ("2147483647,Max,a,b", (2147483647, "Max", "a", "b")),
    ("-2147483648,Min,a,b", (-2147483648, "Min", "a", "b")),
]

REJECTED = [
    ("", "few_fields"), ("318", "few_fields"), ("318,Wilhelmina", "few_fields"), ("318,Wilhelmina,77 Quay Rd", "few_fields"),
    ("abc,n,a,c", "bad_id"), ("12.5,n,a,c", "bad_id"), (",n,a,c", "bad_id"), ("31800000000,n,a,c", "bad_id"),
    ("1e3,Name,Address,Asia", "bad_id"), ("1_0,Name,Address,Asia", "bad_id"),
    ("\x017,Name,Address,Asia", "bad_id"), ("7L,Name,Address,Asia", "bad_id"),
    ("2147483648,Name,Address,Asia", "bad_id"), ("0x10,Name,Address,Asia", "bad_id"),
]


def test_accepted(spark):
    parsed = parse.parse(lines_df(spark, [v for v, _ in ACCEPTED]))
    got = {r["value"]: (r["id"], r["name"], r["address"], r["continent"], r["reject_reason"])
           for r in parsed.collect()}
    for value, rec in ACCEPTED:
        assert got[value] == (*rec, None), value


def test_rejected(spark):
    parsed = parse.parse(lines_df(spark, [v for v, _ in REJECTED]))
    got = {r["value"]: r["reject_reason"] for r in parsed.collect()}
    for value, reason in REJECTED:
        assert got[value] == reason, value
    assert parse.valid(parsed).count() == 0
    assert parse.rejects(parsed).count() == len(REJECTED)


def test_line_filter(spark):
    keep = ["1,a,b,c", "  1,a,b,c  ", "a,b,c,d,e", "\t1,a,b,c　"]
    drop = ["", " \t ", "7;b;c;d", "7,b", "7,b,c;d", "  "]
    out = parse.filter_lines(lines_df(spark, keep + drop)).collect()
    assert sorted(r.value for r in out) == sorted(["1,a,b,c", "1,a,b,c", "a,b,c,d,e", "1,a,b,c"])


def test_split_keeps_newlines_in_last_field(spark):
    from pyspark.sql import functions as F

    from sortpub.functions.text import split_fields

    r = lines_df(spark, ["a,b,c,d\ne,f"]).select(split_fields("value").alias("p")).first()
    assert r.p == ["a", "b", "c", "d\ne,f"]
    assert lines_df(spark, [""]).select(F.size(split_fields("value"))).first()[0] == 1


def test_bucket_label(spark):
    from sortpub.functions.text import bucket_label

    df = lines_df(spark, ["North America", "North_America", "a/b"])
    assert [r[0] for r in df.select(bucket_label("value")).collect()] == ["North_America", "North_America", "a/b"]


@pytest.mark.parametrize("key", ["nope", ""])
def test_unknown_key_raises_before_any_job(spark, key):
    from sortpub.operators.order import total_order
    from tests.conftest import people_df

    with pytest.raises(ValueError):
        total_order(people_df(spark, [(1, "a", "b", "c")]), key)
