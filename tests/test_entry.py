"""Driver contract: entry runs; every query has a callable; oracles name known queries."""

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) == {"sort_key", "offset", "value"}
    assert df.count() > 0


def test_oracle_keys_subset():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    from sortpub.plans.queries import QUERIES

    assert set(QUERIES) <= set(o)          # every query of the library itself has its SQL
