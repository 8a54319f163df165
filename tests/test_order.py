"""Total order, positions, runs, merge, bucket order, auto choice, top-n."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sortpub.operators import order, profile
from sortpub.operators.position import with_position
from tests.conftest import people_df


def offsets_and(df, col):
    return [r[col] for r in df.orderBy("offset").collect()]


def rec(i, name="n", addr="a", cont="Asia"):
    return (i, name, addr, cont)


def test_ids(spark):
    ids = [31, -4, 0, 77, 12, 9, 31]
    out = order.total_order(people_df(spark, [rec(i) for i in ids]), "id")
    assert offsets_and(out, "id") == sorted(ids)
    assert offsets_and(out, "offset") == list(range(len(ids)))


def test_names_bytewise(spark):
    names = ["delta", "Delta", "épsilon", "zeta", "Zeta", "_x", "9"]
    df = people_df(spark, [rec(1, n) for n in names])
    assert offsets_and(order.total_order(df, "name"), "name") == sorted(names, key=lambda s: s.encode())


def test_duplicates_kept(spark):
    df = people_df(spark, [rec(42)] * 5)
    out = order.total_order(df, "id")
    assert offsets_and(out, "offset") == [0, 1, 2, 3, 4]


def test_fields_unchanged(spark):
    rows = [(8, "Hedwig", "44 h", "Africa"), (-2, "Otto", "7 o", "Asia"), (5, "Ida", "1 i", "Europe")]
    out = order.total_order(people_df(spark, rows), "id").orderBy("offset").collect()
    assert [tuple(r)[1:] for r in out] == sorted(rows)


def test_numeric_order_at_low_cardinality(spark):
    # typed values are ordered, not their text ("10" < "9")
    df = people_df(spark, [rec(i) for i in (100, 9, 10, 9, 100)])
    assert offsets_and(order.total_order(df, "id"), "id") == [9, 9, 10, 100, 100]
    b = order.bucket_order(df, "id", partitions=3)
    assert offsets_and(b, "id") == [9, 9, 10, 100, 100]


def test_continents_bucket_order(spark):
    conts = ["Europe", "Africa", "Asia", "North America", "North_America", "Asia"]
    df = people_df(spark, [rec(i, cont=c) for i, c in enumerate(conts)])
    b = order.bucket_order(df, "continent", partitions=4)
    assert offsets_and(b, "continent") == sorted(conts)
    assert offsets_and(b, "offset") == list(range(len(conts)))


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("aqe", ["true", "false"])
def test_positions_equal_row_number(spark, parts, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        rows = [rec(i % 17, f"n{i % 5}", f"a{i}", "Asia" if i % 3 else "Europe") for i in range(500)]
        df = people_df(spark, rows, parts)
        cols = ["id", "name", "address", "continent"]
        out = order.total_order(df, "name", partitions=parts)
        expect = df.withColumn("offset", F.row_number().over(Window.orderBy("name", "id", "address", "continent")) - 1)
        assert sorted(map(tuple, out.select("offset", *cols).collect())) == \
            sorted(map(tuple, expect.select("offset", *cols).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_copies_spread_over_partitions(spark):
    # a third of the rows are identical copies; the source position splits them
    rows = [(i % 3 == 0 and 7 or i, "same" if i % 3 == 0 else f"n{i}", "x", "Asia", 0, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, name string, address string, continent string, partition int, offset long")
    ranged = df.repartitionByRange(8, "id", "name", "address", "continent", "partition", "offset")
    sizes = [r[1] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000
    out = order.total_order(df, "id")
    assert out.count() == 3000 and out.select("offset").distinct().count() == 3000


def test_empty_input(spark):
    df = people_df(spark, [rec(1)]).where(F.lit(False))
    assert order.total_order(df, "id").count() == 0
    assert order.bucket_order(df, "continent").count() == 0
    assert order.sort_all_keys(df).count() == 0


def test_rank_in_runs_and_merge(spark):
    ids = [14, 2, 8, 30, 21, 5, 11]
    df = spark.createDataFrame([(p, i, "n", "a", "c") for p, i in enumerate(ids)],
                               "position long, id int, name string, address string, continent string")
    runs = order.rank_in_runs(df, "id", rows=3).orderBy("run", "rank").collect()
    assert [r.id for r in runs] == [2, 8, 14, 5, 21, 30, 11]
    parts = [people_df(spark, [rec(i) for i in run]) for run in ([40, 10], [20, 10, 50], [30])]
    assert offsets_and(order.merge_runs(parts, "id"), "id") == [10, 10, 20, 30, 40, 50]


def test_sort_auto_threshold(spark):
    few = people_df(spark, [rec(i, cont=f"c{i % 6}") for i in range(300)])
    assert order.sort_auto(few, "continent")[0] == "bucket"
    many = people_df(spark, [rec(i) for i in range(300)])
    assert order.sort_auto(many, "id")[0] == "merge"
    edge = people_df(spark, [rec(i) for i in range(200)])          # 200 distinct: not < 200
    assert order.sort_auto(edge, "id")[0] == "merge"
    below = people_df(spark, [rec(i % 199) for i in range(400)])  # 199 distinct
    strategy, out = order.sort_auto(below, "id")
    assert strategy == "bucket"
    ids = offsets_and(out, "id")
    assert ids == sorted(ids)


def test_top_n(spark):
    df = people_df(spark, [rec(i, f"n{i:03d}") for i in range(100)])
    out = order.top_n(df, "name", 5).orderBy("offset").collect()
    assert [r.name for r in out] == ["n000", "n001", "n002", "n003", "n004"]
    assert [r.offset for r in out] == [0, 1, 2, 3, 4]


def test_positional_numbering(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("x"))
    out = with_position(df, None, "pos").collect()
    assert sorted(r.pos for r in out) == list(range(1000))
    assert all(r.pos == r.x for r in out)


def test_verdict_sees_the_whole_table(spark):
    # the first 500,000 rows share one name; the verdict must not come from them
    df = spark.range(0, 1_000_000, 1, 4).select(
        F.col("id").cast("int").alias("id"), F.when(F.col("id") < 500_000, "same").otherwise(F.concat(F.lit("n"), "id")).alias("name"),
        F.lit("a").alias("address"), F.lit("c").alias("continent"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    p = profile.key_profile(df, "name").first()
    assert (p["rows"], p.distinct_keys, p.strategy) == (1_000_000, 500_001, "merge")


def test_verdict_does_not_change_the_order(spark):
    df = people_df(spark, [rec(i % 50, f"n{i % 7}", f"a{i}") for i in range(300)], 3)
    few, a = order.sort_auto(df, "name")
    many, b = order.sort_auto(df, "name", threshold=3)
    assert (few, many) == ("bucket", "merge")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_files_added_outside_the_session(spark, tmp_path):
    path = str(tmp_path / "records")
    people_df(spark, [rec(i) for i in range(100)]).write.parquet(path)
    assert order.total_order(spark.read.parquet(path), "id").count() == 100
    more = people_df(spark, [rec(i) for i in range(50)])
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.Table.from_pylist([r.asDict() for r in more.collect()], schema=pq.read_schema(next((tmp_path / "records").glob("*.parquet")))), f"{path}/more.parquet")
    assert spark.read.parquet(path).count() == 150
    assert order.total_order(spark.read.parquet(path), "id").count() == 150
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_partitions_of_checkpointed_input_are_known(spark):
    from sortpub.operators.position import range_partitions

    df = spark.range(0, 100, 1, 30).checkpoint()
    assert range_partitions(df) >= 30


def test_sort_all_keys(spark):
    df = people_df(spark, [(2, "b", "x", "Asia"), (1, "c", "y", "Europe"), (3, "a", "z", "Africa")])
    out = order.sort_all_keys(df).collect()
    got = {(r.sort_key, r.offset): r.value for r in out}
    assert got[("id", 0)] == "1,c,y,Europe"
    assert got[("name", 0)] == "3,a,z,Africa"
    assert got[("continent", 0)] == "3,a,z,Africa"
    assert len(out) == 9


def test_bucket_order_keeps_null_keys(spark):
    df = people_df(spark, [rec(i, cont=None if i % 4 == 0 else f"c{i % 3}") for i in range(20)])
    got = order.bucket_order(df, "continent").orderBy("offset").collect()
    assert [r.offset for r in got] == list(range(20))
    assert [r.continent for r in got] == [None] * 5 + sorted(f"c{i % 3}" for i in range(20) if i % 4)


def test_bucket_order_hot_key_spreads(spark):
    # one key holds a third of the rows; salting spreads it over sub-buckets
    rows = [(i, f"n{i}", "x", "Hot" if i % 3 == 0 else f"c{i % 7}", 0, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, name string, address string, continent string, partition int, offset long")
    out = order.bucket_order(df, "continent", partitions=8)
    got = out.orderBy("offset").collect()
    assert [r.offset for r in got] == list(range(3000))
    keys = [r.continent for r in got]
    assert keys == sorted(keys)


def test_hot_copies_without_source_position_spread(spark):
    # a third of the rows are identical and there is no source position: the row mark splits them
    rows = [(7, "same", "x", "Asia") if i % 3 == 0 else (i, f"n{i}", "x", "Asia") for i in range(3000)]
    df = people_df(spark, rows, 4)
    out = order.total_order(df, "id", partitions=8)
    assert out.count() == 3000 and out.select("offset").distinct().count() == 3000
    assert offsets_and(out, "id") == sorted(r[0] for r in rows)


def test_key_profile_exact_and_approx(spark):
    df = people_df(spark, [rec(i % 150, cont=f"c{i % 6}") for i in range(3000)])
    exact = profile.key_profile(df, "continent").first()
    assert (exact["rows"], exact.distinct_keys, exact.strategy) == (3000, 6, "bucket")
    approx = profile.key_profile_approx(df, "id").first()
    assert approx.rows == 3000 and 140 <= approx.approx_distinct_keys <= 160
