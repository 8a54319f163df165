"""Round robin, directory topics: publish, snapshot, stats, append vs replace, peek."""

import pytest
from pyspark.sql import functions as F

from sortpub.operators.partition import bucket_route, read_buckets, round_robin, round_robin_layout
from sortpub.sources import topic
from tests.conftest import lines_df, people_df


def test_round_robin_even(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("x"))
    out = round_robin(df, 3, order=["x"])
    counts = {r.partition: r["count"] for r in out.groupBy("partition").count().collect()}
    assert counts == {0: 1000, 1: 1000, 2: 1000}
    first = out.where(F.col("x") < 6).orderBy("x").collect()
    assert [r.partition for r in first] == [0, 1, 2, 0, 1, 2]
    assert [r.offset for r in first] == [0, 0, 0, 1, 1, 1]
    one = round_robin(df, 1, order=["x"])
    assert one.where(F.col("partition") != 0).count() == 0


def test_round_robin_layout(spark):
    sizes = round_robin_layout(spark.range(0, 3000), 3).groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in sizes) == [1000, 1000, 1000]


def test_publish_snapshot_stats(spark, tmp_out):
    vals = [f"{i},n{i},a,Asia" for i in range(30)] + ["", "bad", "x,y"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, value string")
    m = topic.publish_lines(df, tmp_out, 3, order=["k"])
    assert (m["read"], m["sent"], m["dropped_blank"], m["dropped_few_fields"]) == (33, 30, 1, 2)
    t = topic.read_topic(spark, tmp_out, "source")
    stats = {r.partition: (r.oldest, r.hwm, r.records) for r in topic.topic_stats(t).collect()}
    assert stats == {0: (0, 10, 10), 1: (0, 10, 10), 2: (0, 10, 10)}
    bounds = topic.capture_bounds(spark, tmp_out)
    topic.publish_lines(df, tmp_out, 3, order=["k"], mode="append")
    assert topic.read_topic(spark, tmp_out).count() == 60
    assert topic.snapshot_read(spark, tmp_out, bounds).count() == 30
    after = {r.partition: (r.oldest, r.hwm) for r in topic.topic_stats(topic.read_topic(spark, tmp_out)).collect()}
    assert after == {0: (0, 20), 1: (0, 20), 2: (0, 20)}
    assert topic.read_topic(spark, tmp_out).select("partition", "offset").distinct().count() == 60


def test_rerun_overwrites(spark, tmp_out):
    df = people_df(spark, [(i, f"n{i}", "a", "Asia") for i in range(20)])
    topic.publish_sorted(df, "id", tmp_out)
    topic.publish_sorted(df, "id", tmp_out)
    back = topic.read_topic(spark, tmp_out)
    assert back.count() == 20
    assert [r.offset for r in back.orderBy("offset").collect()] == list(range(20))


def test_publish_sorted_and_peek(spark, tmp_out):
    df = people_df(spark, [(i, f"n{i:02d}", "a", "Asia") for i in range(50)], 5)
    topic.publish_sorted(df, "name", tmp_out)
    peek = topic.peek(spark, tmp_out, 10)
    assert [r.value for r in peek.orderBy("offset").collect()] == [f"{i},n{i:02d},a,Asia" for i in range(10)]
    text = peek._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(offset,10)" in text


def test_overwrite_replaces_all_partitions(spark, tmp_out):
    lines = lines_df(spark, [f"{i},n,a,Asia" for i in range(20)])
    topic.publish_lines(lines, tmp_out, 3)
    topic.publish_sorted(people_df(spark, [(1, "n", "a", "Asia"), (2, "n", "a", "Asia")]), "id", tmp_out)
    assert topic.read_topic(spark, tmp_out).count() == 2
    assert topic.read_manifest(spark, tmp_out) == [(0, 0, 2, 2)]


def test_modes(spark, tmp_out):
    two, five = (lines_df(spark, [f"{i},n,a,Asia" for i in range(n)]) for n in (2, 5))
    topic.publish_lines(five, tmp_out, 3)
    assert topic.publish_lines(two, tmp_out, 3, mode="ignore")["sent"] == 0
    assert topic.read_topic(spark, tmp_out).count() == 5
    with pytest.raises(ValueError):
        topic.publish_lines(two, tmp_out, 3, mode="error")
    with pytest.raises(ValueError):
        topic.publish_lines(two, tmp_out, 3, mode="replace")
    topic.publish_lines(two, tmp_out, 3, mode="append")
    assert topic.read_manifest(spark, tmp_out) == [(0, 0, 3, 3), (1, 0, 3, 3), (2, 0, 1, 1)]
    assert topic.read_topic(spark, tmp_out).select("partition", "offset").distinct().count() == 7


def test_manifest_of_any_topic(spark, tmp_out):
    rows = spark.range(0, 1000).select((F.col("id") % 100).cast("int").alias("partition"), F.expr("id div 100").alias("offset"), F.col("id").cast("string").alias("value"))
    topic.write_topic(rows.where("offset < 4"), tmp_out)
    bounds = topic.capture_bounds(spark, tmp_out)
    topic.write_topic(rows.where("offset >= 4"), tmp_out, mode="append")
    assert topic.snapshot_read(spark, tmp_out, bounds).count() == 400
    assert topic.capture_bounds(spark, tmp_out) == [(p, 0, 10) for p in range(100)]


def test_hot_order_value_is_split(spark, tmp_out):
    df = spark.range(0, 4000, 1, 8).select(F.lit("same").alias("k"), F.concat(F.col("id").cast("string"), F.lit(",n,a,c")).alias("value"))
    topic.publish_lines(df, tmp_out, 3, order=["k"])
    t = topic.read_topic(spark, tmp_out)
    assert t.count() == 4000 and t.select("partition", "offset").distinct().count() == 4000


class StubWriter:
    """Stands for a frame's writer: keeps format and options."""

    def __init__(self, seen):
        self.seen = seen

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def save(self):
        self.seen["saved"] = True


def test_kafka_sink_options_and_frame(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    seen = {}
    frames = []
    real = topic.kafka_frame
    monkeypatch.setattr(topic, "kafka_frame", lambda df: frames.append(real(df)) or frames[-1])
    monkeypatch.setattr(DataFrame, "write", property(lambda self: StubWriter(seen)))
    sink = topic.kafka_sink("host:9092", "people", {"kafka.acks": "all"})
    msgs = spark.createDataFrame([(0, 7, "1,a,b,c")], "partition int, offset long, value string")
    sink(msgs)
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "people", "kafka.acks": "all", "saved": True}
    assert [tuple(r) for r in frames[0].collect()] == [("0000000000000000007", "1,a,b,c", 0)]
    assert topic.kafka_read_options("h:1", "t", options={"failOnDataLoss": "true"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest", "failOnDataLoss": "true"}


def test_publish_to_a_sink_function(spark):
    got = []
    df = people_df(spark, [(i, f"n{i}", "a", "Asia") for i in (3, 1, 2)])
    m = topic.publish_sorted(df, "id", lambda msgs: got.extend(msgs.collect()))
    assert sorted((r.partition, r.offset, r.value) for r in got) == [(0, i, f"{i + 1},n{i + 1},a,Asia") for i in range(3)] and m["sent"] == 3
    got.clear()
    m = topic.publish_lines(lines_df(spark, ["1,a,b,c", "", "2,a,b,c"]), lambda msgs: got.extend(msgs.collect()))
    assert len(got) == 2 and m["dropped_blank"] == 1


def test_empty_source(spark, tmp_out):
    df = lines_df(spark, ["", "   "])
    m = topic.publish_lines(df, tmp_out, 3)
    assert m["sent"] == 0 and m["dropped_blank"] == 2
    assert topic.snapshot_read(spark, tmp_out).count() == 0


def test_bucket_route_keeps_keys_apart(spark, tmp_out):
    rows = [(1, "a", "x", "North America"), (2, "b", "x", "North_America"), (3, "c", "x", "a/b"),
            (4, "d", "x", "North America")]
    bucket_route(people_df(spark, rows), "continent", tmp_out)
    back = read_buckets(spark, tmp_out, "continent")
    got = {r.continent: r["count"] for r in back.groupBy("continent").count().collect()}
    assert got == {"North America": 2, "North_America": 1, "a/b": 1}


def test_sorted_append_continues_offsets(spark, tmp_out):
    df = people_df(spark, [(i, f"n{i}", "a", "Asia") for i in range(15)])
    topic.publish_sorted(df, "id", tmp_out)
    topic.publish_sorted(df, "id", tmp_out, mode="append")
    back = topic.read_topic(spark, tmp_out)
    assert sorted(r.offset for r in back.collect()) == list(range(30))
    assert {r.partition for r in back.collect()} == {0}
