"""Full-table checks: order (inner and block-edge faults), conservation, domains."""

from pyspark.sql import functions as F

from sortpub.operators import verify
from sortpub.sources.generate import generate_people
from tests.conftest import people_df


def frame(spark, keys):
    return spark.createDataFrame(list(enumerate(keys)), "offset long, k long")


def test_check_sorted_good_and_faults(spark):
    good = verify.check_sorted(frame(spark, list(range(100))), "k", block=10).first()
    assert good.sorted and good.out_of_order == 0 and not good.position_gaps and good.rows == 100
    inner = list(range(100)); inner[5], inner[6] = inner[6], inner[5]
    assert verify.check_sorted(frame(spark, inner), "k", block=10).first().out_of_order == 1
    edge = list(range(100)); edge[9], edge[10] = edge[10], edge[9]   # fault across blocks 0 | 1
    r = verify.check_sorted(frame(spark, edge), "k", block=10).first()
    assert r.out_of_order == 1 and not r.sorted
    gap = spark.createDataFrame([(0, 1), (1, 2), (3, 3)], "offset long, k long")
    assert verify.check_sorted(gap, "k").first().position_gaps
    late = spark.createDataFrame([(1, 1), (2, 2)], "offset long, k long")
    assert verify.check_sorted(late, "k").first().position_gaps
    dup = spark.createDataFrame([(0, 1), (1, 2), (1, 3)], "offset long, k long")
    assert not verify.check_sorted(dup, "k").first().sorted


def test_check_sorted_empty(spark):
    r = verify.check_sorted(frame(spark, []).where(F.lit(False)), "k").first()
    assert r.rows == 0 and r.sorted


def test_check_conserved(spark):
    a = people_df(spark, [(1, "a", "x", "c"), (1, "a", "x", "c"), (2, "b", "y", "d")])
    same = verify.check_conserved(a, a.orderBy("id")).first()
    assert (same.missing, same.extra, same.fingerprint_equal) == (0, 0, True)
    b = people_df(spark, [(1, "a", "x", "c"), (2, "b", "y", "d"), (3, "z", "z", "z")])
    d = verify.check_conserved(a, b).first()
    assert (d.rows_in, d.rows_out, d.missing, d.extra, d.fingerprint_equal) == (3, 3, 1, 1, False)
    fast = verify.check_conserved(a, b, exact=False).first()
    assert not fast.fingerprint_equal


def test_generated_data_in_domains(spark):
    df = generate_people(spark, 5000, seed=7)
    got = {r.rule: r.violations for r in verify.check_domains(df).collect()}
    assert set(got.values()) == {0}, got
    bad = people_df(spark, [(-1, "short", "bad", "Mars")])
    got = {r.rule: r.violations for r in verify.check_domains(bad).collect()}
    assert got["id_range"] == 1 and got["name_length"] == 1 and got["continent_known"] == 1
