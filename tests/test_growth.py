"""What must not grow with the input: batches of a bounded stream, rows that one task sorts or sends."""

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
from sortpub.plans import queries
from sortpub.sources import kafka_order
from sortpub.streaming import topics

from .conftest import SF, lines_df, people_df


def many_files(spark, path, n):
    """``n`` files of one line each, among them a blank one and one of few fields."""
    values = [f"{i},n,a,c" for i in range(n - 2)] + ["  ", "x,y"]
    lines_df(spark, values).coalesce(1).write.option("maxRecordsPerFile", 1).text(path)
    return path


def test_files_follow_the_backlog(spark, tmp_out):
    many_files(spark, f"{tmp_out}/in/part=0", 35)
    assert topics.files_per_batch(spark, f"{tmp_out}/in") == 3
    assert topics.files_per_batch(spark, f"{tmp_out}/in", least=4) == 4
    assert topics.files_per_batch(spark, f"{tmp_out}/in", batches=2) == 18


def test_topic_batches_do_not_grow_with_the_files(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(queries, "_line_files", lambda *_: many_files(spark, f"{tmp_out}/in", 90))
    taken, append = [], topics.append_batch
    monkeypatch.setattr(topics, "append_batch", lambda rows, number, *a: (taken.append(number), append(rows, number, *a))[1])
    got = __spark_entry__.queries()["stream_topic"](spark, SF).collect()
    assert 1 < len(set(taken)) <= 16 and len(taken) == 2 * len(set(taken))
    assert sorted(r.value for r in got) == sorted(f"{i},n,a,c" for i in range(88)) and {r.positions for r in got} == {88}


def test_counter_batches_do_not_grow_with_the_files(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(queries, "_line_files", lambda *_: many_files(spark, f"{tmp_out}/in", 90))
    listeners, totals = [], topics.Counters.totals
    monkeypatch.setattr(topics.Counters, "totals", lambda self, *a: (listeners.append(self), totals(self, *a))[1])
    got = __spark_entry__.queries()["stream_metrics"](spark, SF).collect()
    assert [tuple(r) for r in got] == [(90, 1, 1)]
    assert 1 < len(listeners[0].batches) <= 16


# -- Kafka partitions -------------------------------------------------------------------------

def test_no_two_partitions_share_a_task(spark):
    rows = [(p, i, f"v{p}.{i}") for p in range(8) for i in range(5)]
    sent = kafka_order.to_send(spark.createDataFrame(rows, "partition int, place long, value string"), 8)
    tasks = sent.select("partition", F.spark_partition_id().alias("t")).distinct().collect()
    assert len(tasks) == len({r.t for r in tasks}) == 8


def test_order_is_sent_in_waves_of_bounded_shards(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(kafka_order, "SHARD_BYTES", 1_000, raising=False)
    rows = [(i * 37 % 900, f"n{i % 2}", "a", "Asia") for i in range(900)] + [(7, "n1", "a", "Asia")] * 100
    calls = []

    def send(frame):
        marked = frame.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
        calls.append([tuple(r) for r in marked.orderBy("at").collect()])
        frame.write.mode("append").parquet(f"{tmp_out}/sent")

    m = kafka_order.publish_in_order(people_df(spark, rows, 4), "name", send, 3, f"{tmp_out}/bounds")
    want = [f"{i},{n},a,Asia" for n, i in sorted((n, i) for i, n, *_ in rows)]
    assert (m["sent"], m["bytes"]) == (1_000, sum(map(len, want)))
    # no task sorts or sends more than a shard, sampling allowed for
    for call in calls:
        sizes = Counter(task for *_, task, _ in call)
        assert max(sizes.values()) <= 160 and len({(p, t) for _, _, p, t, _ in call}) == len(sizes)
    # a partition's messages follow each other over the waves, and the partitions are the order
    got = {p: [(int(k), v) for call in calls for k, v, q, *_ in call if q == p] for p in range(3)}
    assert all([k for k, _ in x] == list(range(len(x))) for x in got.values())
    assert [v for p in range(3) for _, v in got[p]] == want
    back = kafka_order.read_in_order(spark, spark.read.parquet(f"{tmp_out}/sent"), f"{tmp_out}/bounds")
    assert [tuple(r) for r in back.orderBy("offset").collect()] == list(enumerate(want))


def test_nothing_to_send(spark, tmp_out):
    sent = []
    m = kafka_order.publish_in_order(people_df(spark, []), "id", lambda f: sent.append(f.count()), 3, f"{tmp_out}/bounds")
    assert (m["sent"], m["bytes"], sent) == (0, 0, [0]) and spark.read.parquet(f"{tmp_out}/bounds").count() == 0
