"""One-pass line files, long lines, clashing columns, Kafka partitions, differing records, streams into topics."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sortpub.operators import differ, order
from sortpub.operators.partition import round_robin
from sortpub.operators.position import with_position
from sortpub.sources import generate, kafka_order, lines as line_io, topic
from sortpub.streaming import topics
from tests.conftest import lines_df, people_df


def local(path):
    return path.replace("file:", "")


# -- line files --------------------------------------------------------------------------

@pytest.mark.parametrize("limit", [0, 2, 7, 10, 1000])
def test_record_limit_keeps_every_line(spark, tmp_out, limit):
    vals = [f"{i},n,a,c" for i in range(100)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", str(limit))
    try:
        line_io.write_lines(lines_df(spark, vals).repartition(3), tmp_out)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = glob.glob(os.path.join(local(tmp_out), "*.txt"))
    texts = [open(f).read().splitlines() for f in files]
    assert all(t[0] == line_io.HEADER and len(t) > 1 for t in texts) and (not limit or max(map(len, texts)) <= limit)
    assert sorted(r.value for r in line_io.read_lines(spark, tmp_out).collect()) == sorted(vals)


def test_record_limit_of_one_raises(spark, tmp_out):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    try:
        with pytest.raises(ValueError):
            line_io.write_lines(lines_df(spark, ["1,a,b,c"]), tmp_out)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_source_is_computed_once(spark, tmp_out):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = lines_df(spark, [f"{i},n,a,c" for i in range(50)] + ["a\nb"]).mapInArrow(count, "value string")
    line_io.write_lines(df, f"{tmp_out}/lines", rejects=f"{tmp_out}/rejects")
    assert seen.value == 51
    assert line_io.read_lines(spark, f"{tmp_out}/lines").count() == 50 and spark.read.parquet(f"{tmp_out}/rejects").count() == 1


def test_long_lines(spark):
    bound = line_io.bounded_lines(lines_df(spark, ["x" * 10, "x" * 11, "ü" * 5, "ü" * 6, ""]), max_bytes=10)
    assert sorted(r.value for r in line_io.kept_lines(bound).collect()) == ["", "x" * 10, "ü" * 5]
    assert sorted((r.value_bytes, r.reject_reason) for r in line_io.long_lines(bound).collect()) == [(11, "too_long"), (12, "too_long")]
    at = line_io.bounded_lines(lines_df(spark, ["y" * line_io.MAX_LINE_BYTES, "y" * (line_io.MAX_LINE_BYTES + 1)]))
    assert line_io.kept_lines(at).count() == 1 and line_io.long_lines(at).count() == 1


# -- generator -----------------------------------------------------------------------------

def test_draws_cover_their_domains_evenly(spark):
    df = generate.generate_people(spark, 40_000, seed=9)
    shares = {r.continent: r["count"] for r in df.groupBy("continent").count().collect()}
    assert len(shares) == 6 and all(abs(n - 40_000 / 6) < 450 for n in shares.values())
    sizes = {r.n: r["count"] for r in df.groupBy(F.length("name").alias("n")).count().collect()}
    assert sorted(sizes) == list(range(10, 16)) and all(abs(n - 40_000 / 6) < 450 for n in sizes.values())
    for at in (1, 2, 9, 10):
        letters = {r.c: r["count"] for r in df.groupBy(F.substring("name", at, 1).alias("c")).count().collect()}
        assert len(letters) == 52 and all(abs(n - 40_000 / 52) < 160 for n in letters.values())
    assert df.agg(F.avg("id")).first()[0] == pytest.approx(25e6, rel=0.02)
    assert df.where(~F.col("address").rlike("^[0-9][A-Za-z0-9 ] [A-Za-z0-9 ]{12,17}$")).count() == 0


def test_column_functions(spark):
    k = F.col("id")
    df = spark.range(0, 5000).select(generate.random_int(k, 3, 10, 1).alias("i"), generate.choice(k, 4, ("a", "b", "c"), 1).alias("c"),
                                     generate.random_string(k, 5, "xyz", 2, 13, 1).alias("s"))
    got = df.agg(F.min("i"), F.max("i"), F.count_distinct("c"), F.min(F.length("s")), F.max(F.length("s")),
                 F.count_if(~F.col("s").rlike("^[xyz]+$"))).first()
    assert tuple(got) == (0, 9, 3, 2, 13, 0)


# -- positions -----------------------------------------------------------------------------

def test_columns_named_like_internals(spark, tmp_out):
    names = ["_m", "_p", "_i", "row", "p", "i", "n", "base", "_none"]
    df = people_df(spark, [(i % 7, f"n{i}", "a", "Asia") for i in range(50)], 3).select("*", *[F.concat(F.lit(c), "name").alias(c) for c in names])
    want = sorted(tuple(r) for r in df.collect())
    for out in (with_position(df, [F.col("id"), F.col("name")], "pos"), with_position(df, None, "pos")):
        assert sorted(tuple(r)[:-1] for r in out.collect()) == want and sorted(r.pos for r in out.collect()) == list(range(50))
    assert sorted(tuple(r)[1:] for r in order.total_order(df, "id").collect()) == want
    assert sorted(tuple(r)[2:] for r in round_robin(df, 3, order=["id", "name"]).collect()) == want
    assert sorted(tuple(r)[2:] for r in round_robin(df, 3).collect()) == want
    topic.publish_sorted(df, "id", tmp_out)
    assert topic.read_topic(spark, tmp_out).count() == 50
    assert with_position(df.select("id"), ["id"], "id").agg(F.max("id")).first()[0] == 49


# -- Kafka partitions ------------------------------------------------------------------------

def test_partitions_in_order(spark, tmp_out):
    rows = [(i * 37 % 500, f"n{i % 11}", "a", "Asia") for i in range(500)]
    got = {}

    def send(frame):
        frame.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{tmp_out}/sent")

    m = kafka_order.publish_in_order(people_df(spark, rows, 4), "name", send, 5, f"{tmp_out}/bounds")
    assert m["sent"] == 500
    sent = spark.read.parquet(f"{tmp_out}/sent")
    for r in sent.orderBy("at").collect():
        got.setdefault(r.partition, []).append((r.task, int(r.key), r.value))
    want = [f"{i},{n},a,Asia" for n, i in sorted((n, i) for i, n, *_ in rows)]
    assert [v for p in sorted(got) for _, _, v in got[p]] == want and len(got) > 1
    assert all(len({t for t, _, _ in x}) == 1 and [k for _, k, _ in x] == list(range(len(x))) for x in got.values())
    # a retried task sends some messages again; a lost one shows
    doubled = sent.unionByName(sent.where("partition = 1"))
    back = kafka_order.read_in_order(spark, doubled, f"{tmp_out}/bounds")
    assert [tuple(r) for r in back.orderBy("offset").collect()] == list(enumerate(want))
    assert kafka_order.missing(spark, sent, f"{tmp_out}/bounds").count() == 0
    lost = kafka_order.missing(spark, sent.where("not (partition = 1 and cast(key as long) = 0)"), f"{tmp_out}/bounds").collect()
    assert [(r.partition, r.expected - r.received) for r in lost] == [(1, 1)]
    bounds = spark.read.parquet(f"{tmp_out}/bounds").orderBy("partition").collect()
    assert [b.first_key for b in bounds] == sorted(b.first_key for b in bounds) and bounds[0].base == 0


def test_ordering_producer_options():
    got = kafka_order.writer_options("h:1", "t", {"kafka.acks": "1"})
    assert got == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.enable.idempotence": "true", "kafka.acks": "1"}


# -- differing records -----------------------------------------------------------------------

@pytest.mark.parametrize("cap", [differ.MAX_RANGES, 3])
def test_differences(spark, cap, monkeypatch):
    monkeypatch.setattr(differ, "MAX_RANGES", cap)
    rows = [(i, f"n{i}", None if i % 5 == 0 else "x", "Asia") for i in range(3000)] + [(1, "n1", "x", "Asia")] * 4
    a = people_df(spark, rows)
    assert differ.differences(a, a.repartition(7)).count() == 0
    b = people_df(spark, [r for r in rows if r[0] not in (5, 17)] + [(9, "n9", "x", "Asia"), (9999, "new", "x", "Asia"), (9999, "new", "x", "Asia")])
    b = b.withColumn("continent", F.when(F.col("id") == 20, F.lit("Africa")).otherwise(F.col("continent")))
    got = {tuple(r) for r in differ.differences(a, b).collect()}
    assert got == {("missing", 5, "n5", None, "Asia", 1), ("missing", 17, "n17", "x", "Asia", 1), ("extra", 9, "n9", "x", "Asia", 1),
                   ("extra", 9999, "new", "x", "Asia", 2), ("missing", 20, "n20", None, "Asia", 1), ("extra", 20, "n20", None, "Africa", 1)}
    assert differ.differences(a.where("false"), a.where("false")).count() == 0


def test_differences_shuffle_only_differing_ranges(spark):
    a = people_df(spark, [(i, f"n{i}", "x", "Asia") for i in range(20000)])
    tagged = differ._tagged(a, a.where("id <> 77"), a.columns)
    one = differ.differing_ranges(tagged, 1)
    two = differ.differing_ranges(tagged, 2, one)
    assert one.count() == 1 and two.count() == 1


# -- streams -------------------------------------------------------------------------------

def test_replayed_batches_add_nothing(spark, tmp_out):
    for k in range(3):
        lines_df(spark, [f"{i},n,a,c" for i in range(10 * k, 10 * k + 10)] + ["bad"]).coalesce(1).write.text(f"{tmp_out}/in/part={k}")
    seen = []

    def again(rows, number):
        topics.append_batch(rows, number, f"{tmp_out}/t", "s")
        seen.append(number)

    stream = topics.line_stream(spark, f"{tmp_out}/in", max_files=1).select("value")
    n = topics.stream_to_topic(stream, f"{tmp_out}/t", "s", each=again)
    t = topic.read_topic(spark, f"{tmp_out}/t")
    assert n == len(seen) >= 3 and t.count() == 30
    assert t.select("partition", "offset").distinct().count() == 30
    # another stream's batches of the same numbers are its own
    topics.append_batch(lines_df(spark, ["1,a,b,c"]), 0, f"{tmp_out}/t", "other")
    assert topic.read_topic(spark, f"{tmp_out}/t").count() == 31


def test_stream_counters_equal_batch_counters(spark, tmp_out):
    vals = [f"{i},n,a,c" for i in range(40)] + ["", "  ", "x,y"]
    lines_df(spark, vals).repartition(4).write.text(f"{tmp_out}/in")
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).schema("value string").load(f"{tmp_out}/in")
    from sortpub.operators.parse import judge_lines

    rows, listener = topics.observed_stream(judge_lines(raw), topic.line_counters(), "judged")
    q = rows.writeStream.format("noop").trigger(availableNow=True).start()
    q.awaitTermination()
    total = listener.totals(spark)
    spark.streams.removeListener(listener)
    assert total == {"read": 43, "dropped_blank": 2, "dropped_few_fields": 1} and len(listener.batches) >= 4
