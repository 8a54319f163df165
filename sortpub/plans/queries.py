"""Registered queries: one per inventory item, each (spark, sf_dir) -> DataFrame.

Inputs are the views of ``sortpub.plans.views`` over the driver's tables; queries that
write (topics, line files, buckets, streams) write under the shared checkpoint root
and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.functions.text import bucket_label, split_fields, strict_int, trim_ws
from sortpub.operators import differ, order, parse, profile, verify
from sortpub.operators.partition import bucket_route, read_buckets, round_robin
from sortpub.operators.position import with_position
from sortpub.plans import views
from sortpub.schema import RECORD_COLUMNS, key_text, serialize
from sortpub.session import literal_frame, scratch_path, stage
from sortpub.sources import generate, kafka_order, lines as line_io, sketches, topic
from sortpub.streaming import topics
from sortpub.streaming.snapshot import stream_snapshot

Query = Callable[[SparkSession, str], DataFrame]
REC = RECORD_COLUMNS
KEY = ["o_orderkey"]          # what tells the lines apart
RUN_CHUNK = 1_000
TOP_N = 10
PEEK_N = 10
BATCH_FILES = 4               # files that a batch of a stream takes at least


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse(views.lines(spark, sf), keep=KEY)


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return parse.valid(_parsed(spark, sf), keep=KEY)


# ---- 2.2 projections, filters, scalar functions -------------------------------------

def q_line_filter(spark, sf):
    return parse.filter_lines(views.lines(spark, sf)).select("o_orderkey", "value")


def q_doc_line_filter(spark, sf):
    return parse.filter_lines(views.doc_lines(spark, sf)).select("doc_id", "value")


def q_split_limit4(spark, sf):
    parts = split_fields("value", 4)
    return views.doc_lines(spark, sf).select(
        "doc_id", F.size(parts).alias("n_fields"),
        *[F.get(parts, i).alias(f"f{i}") for i in range(4)])


def q_trim_fields(spark, sf):
    parts = split_fields("value", 4)
    return views.lines(spark, sf).select(
        "o_orderkey", *[trim_ws(F.get(parts, i)).alias(f"f{i}") for i in range(4)])


def q_strict_int(spark, sf):
    f0 = trim_ws(F.get(split_fields("value", 4), 0))
    return views.lines(spark, sf).select("o_orderkey", f0.alias("id_text"), strict_int(f0).alias("id"))


def q_parse_valid(spark, sf):
    return _valid(spark, sf)


def q_parse_rejects(spark, sf):
    return parse.rejects(_parsed(spark, sf), keep=KEY)


def q_serialize_record(spark, sf):
    return views.people(spark, sf, keep_orderkey=True).select("o_orderkey", serialize().alias("value"))


def q_key_text(spark, sf):
    return _valid(spark, sf).select(*KEY, *[key_text(k).alias(f"{k}_key") for k in ("id", "name", "continent")])


def q_bucket_label(spark, sf):
    counts = profile.bucket_counts(_valid(spark, sf), "continent")
    return counts.select("continent", bucket_label("continent").alias("label"), "records")


# ---- 2.3 partitioning -----------------------------------------------------------------

def q_round_robin(spark, sf):
    docs = views.doc_lines(spark, sf).select("doc_id")
    return round_robin(docs, views.TOPIC_PARTITIONS, order=["doc_id"])


def q_bucket_route(spark, sf):
    path = scratch_path(spark, "buckets_continent")
    bucket_route(_valid(spark, sf).select(*REC), "continent", path)
    return read_buckets(spark, path, "continent").select(*REC)


# ---- 2.4 sorts, positions, top-n --------------------------------------------------------

def q_sort_by_id(spark, sf):
    return order.total_order(_valid(spark, sf), "id", tiebreak=KEY)


def q_sort_by_name(spark, sf):
    return order.total_order(_valid(spark, sf), "name", tiebreak=KEY)


def q_sort_by_continent(spark, sf):
    return order.total_order(_valid(spark, sf), "continent", tiebreak=KEY)


def q_global_position(spark, sf):
    return with_position(views.lines(spark, sf).select("o_orderkey"), [F.col("o_orderkey")], name="position")


def _arrival(spark, sf):
    v = _valid(spark, sf)
    return v.select(F.col("o_orderkey").alias("position"), *REC)


def q_sorted_runs(spark, sf):
    return order.rank_in_runs(_arrival(spark, sf), "id", rows=RUN_CHUNK)


def q_merge_runs(spark, sf):
    v = _valid(spark, sf)
    inputs = [v.where(F.col("o_orderkey") % views.TOPIC_PARTITIONS == p) for p in range(views.TOPIC_PARTITIONS)]
    return order.merge_runs(inputs, "name", tiebreak=KEY)


def _null_keys(spark, sf):
    """Records of which some have no continent (by key)."""
    v = _valid(spark, sf)
    return v.withColumn("continent", F.when(F.col("o_orderkey") % 11 != 0, F.col("continent")))


def q_bucket_order(spark, sf):
    return order.bucket_order(_null_keys(spark, sf), "continent", tiebreak=KEY).select("offset", "continent")


def q_sort_auto(spark, sf):
    verdict, out = order.sort_auto(views.low_name(spark, sf), "name")
    return out.select("offset", "name", F.lit(verdict).alias("strategy"))


def q_sort_auto_id(spark, sf):
    verdict, out = order.sort_auto(_valid(spark, sf), "id", tiebreak=KEY)
    return out.select("offset", *REC, F.lit(verdict).alias("strategy"))


def q_sort_all_keys(spark, sf):
    return order.sort_all_keys(_valid(spark, sf), tiebreak=KEY)


def q_top_n(spark, sf):
    return order.top_n(_valid(spark, sf), "name", TOP_N, tiebreak=KEY)


# ---- 2.5 aggregations -------------------------------------------------------------------

def q_key_profile(spark, sf):
    v = stage(_valid(spark, sf))
    return reduce(DataFrame.unionByName, [profile.key_profile(v, k) for k in ("id", "name", "continent")])


def q_key_sketch(spark, sf):
    """Distinct keys of a topic by sketches, after an append whose files alone are read; beside the exact number.

    ``within``: the estimate is off by 5 % at most (three standard errors).
    """
    v = stage(_valid(spark, sf))
    path = scratch_path(spark, "sketched")
    third = F.col("o_orderkey") % 3 == 0
    for rows, mode in ((third, "overwrite"), (~third, "append")):
        topic.publish_sorted(v.where(rows), "name", path, mode=mode, columns=REC, tiebreak=KEY)
        sketches.update(spark, path)
    exact = reduce(DataFrame.unionByName, [profile.key_profile(v, k).select("sort_key", F.col("distinct_keys").alias("exact")) for k in ("id", "name", "continent")])
    return sketches.key_estimates(spark, path).join(exact, "sort_key").select(
        "sort_key", "rows", F.col("exact").alias("distinct_keys"),
        (F.abs(F.col("distinct_keys") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within"))


def q_bucket_counts(spark, sf):
    return profile.bucket_counts(_valid(spark, sf), "continent")


def q_publish_metrics(spark, sf):
    m = topic.publish_lines(views.lines(spark, sf), scratch_path(spark, "source"), order=KEY, unique=True)
    names = ["read", "dropped_blank", "dropped_few_fields", "sent", "bytes"]
    return literal_frame(spark, [tuple(m[n] for n in names)], [(n, "long") for n in names])


def q_run_stats(spark, sf):
    return profile.run_stats(order.rank_in_runs(_arrival(spark, sf), "id", rows=RUN_CHUNK), "id")


# ---- 2.6 verification -----------------------------------------------------------------

def _published_name(spark, sf) -> tuple[DataFrame, DataFrame]:
    v = stage(_valid(spark, sf))
    path = scratch_path(spark, "name")
    topic.publish_sorted(v, "name", path, tiebreak=KEY)
    back = parse.parse(topic.read_topic(spark, path, "name"), keep=["offset"])
    return v, parse.valid(back, keep=["offset"])


def q_check_sorted(spark, sf):
    """The published order, and a damaged copy of it: two neighbours swapped across a block edge, a hole, a repeat."""
    _, back = _published_name(spark, sf)
    good = verify.check_sorted(back, "name").select(F.lit("published").alias("topic"), "*")
    o = F.col("o_orderkey")
    bad = views.table(spark, sf, "orders").select(
        o.alias("k"), F.when(o % 1000 == 500, o + 1).when(o % 1000 == 501, o - 1).when(o % 5000 == 7, o + 1).otherwise(o).alias("offset"))
    return good.unionByName(verify.check_sorted(bad, "k", block=100).select(F.lit("damaged").alias("topic"), "*"))


def q_check_conserved(spark, sf):
    v, back = _published_name(spark, sf)
    return verify.check_conserved(v.select(*REC), back.select(*REC))


def q_record_differences(spark, sf):
    """Records against a copy in which some are lost, some renamed and some doubled."""
    v = stage(_valid(spark, sf))
    k = F.col("o_orderkey")
    changed = v.where(k % 97 != 0).withColumn("name", F.when(k % 89 == 0, F.concat("name", F.lit("x"))).otherwise(F.col("name")))
    copy = changed.unionByName(v.where(k % 83 == 0))
    return differ.differences(v, copy, REC)


def q_check_domains(spark, sf):
    return verify.check_domains(_valid(spark, sf))


# ---- 2.1 sources and sinks ----------------------------------------------------------

def q_generate_people(spark, sf):
    return generate.generate_for(views.table(spark, sf, "orders"), "o_orderkey")


def q_csv_roundtrip(spark, sf):
    path, rejects = scratch_path(spark, "people_csv"), scratch_path(spark, "people_rejects")
    line_io.write_records(_valid(spark, sf).select(*REC), path, rejects=rejects)
    back = parse.parse(line_io.read_lines(spark, path))
    return parse.valid(back)


def q_line_roundtrip(spark, sf):
    """Lines that are hard to keep: what comes back, and what went to the rejects."""
    path, rejects = scratch_path(spark, "hard_lines"), scratch_path(spark, "hard_rejects")
    line_io.write_lines(views.hard_lines(spark, sf), path, rejects=rejects)
    back = line_io.read_lines(spark, path).select("value", F.lit(True).alias("written"))
    return back.unionByName(spark.read.parquet(rejects).select("value", F.lit(False).alias("written")))


def q_read_lines(spark, sf):
    path = scratch_path(spark, "lines_csv")
    line_io.write_lines(views.lines(spark, sf), path)
    return line_io.read_lines(spark, path)


def q_publish_source(spark, sf):
    path = scratch_path(spark, "source")
    topic.publish_lines(views.lines(spark, sf), path, order=KEY, unique=True)
    return topic.read_topic(spark, path, "source").select("partition", "offset", "value")


def _events_topic(spark, sf) -> str:
    path = scratch_path(spark, "event_topic")
    topic.write_topic(views.event_topic(spark, sf), path)
    return path


def q_snapshot_read(spark, sf):
    path = _events_topic(spark, sf)
    bounds = topic.capture_bounds(spark, path)
    # Messages arriving after the bounds were taken must not be read.
    late = topic.read_topic(spark, path).select("partition", (F.col("offset") + F.lit(1 << 40)).alias("offset"),
                                                "value", "timestamp")
    topic.write_topic(late, path, mode="append")
    return topic.snapshot_read(spark, path, bounds).select("partition", "offset", "value", "timestamp")


def q_topic_stats(spark, sf):
    path = _events_topic(spark, sf)
    return topic.topic_stats(topic.read_topic(spark, path, "event_topic"))


def q_stored_stats(spark, sf):
    """The statistics of a topic written in two commits, from its manifest alone."""
    path, events = scratch_path(spark, "event_topic"), stage(views.event_topic(spark, sf))
    for rows, mode in ((F.col("offset") % 3 != 0, "overwrite"), (F.col("offset") % 3 == 0, "append")):
        topic.write_topic(events.where(rows), path, mode=mode)
    return topic.stored_stats(spark, path)


def q_append_vs_replace(spark, sf):
    """Publish twice by each mode; last, a sorted topic over one of three partitions."""
    lines, records = stage(views.lines(spark, sf)), stage(_valid(spark, sf))

    def totals(path, mode):
        return topic.read_topic(spark, path).agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("records"),
            F.count_distinct("partition", "offset").alias("distinct_positions"), F.count_distinct("partition").alias("partitions"))

    out = []
    for mode in ("append", "overwrite", "ignore"):
        path = scratch_path(spark, f"source_{mode}")
        for rows in (lines, lines.where(F.col("o_orderkey") % 2 == 0) if mode == "ignore" else lines):
            topic.publish_lines(rows, path, order=KEY, mode=mode, unique=True)
        out.append(totals(path, mode))
    path = scratch_path(spark, "replaced")
    topic.publish_lines(lines, path, order=KEY, unique=True)
    topic.publish_sorted(records, "id", path, tiebreak=KEY)
    return reduce(DataFrame.unionByName, [*out, totals(path, "sorted over lines")])


def q_publish_sorted(spark, sf):
    path = scratch_path(spark, "id")
    topic.publish_sorted(_valid(spark, sf), "id", path, tiebreak=KEY)
    return topic.read_topic(spark, path, "id").select("offset", "value")


def q_append_sorted(spark, sf):
    """A third of the records, then the others, appended into the order by name."""
    v = stage(_valid(spark, sf))
    path = scratch_path(spark, "name")
    topic.publish_sorted(v.where(F.col("o_orderkey") % 3 == 0), "name", path, columns=REC, tiebreak=KEY)
    topic.publish_sorted(v.where(F.col("o_orderkey") % 3 != 0), "name", path, mode="append", columns=REC, tiebreak=KEY)
    return topic.read_topic(spark, path, "name").select("offset", "value")


def q_publish_partitions(spark, sf):
    """The order by continent over four partitions, as they are sent to Kafka, put together again from their bounds."""
    path, bounds = scratch_path(spark, "partitions"), scratch_path(spark, "bounds")
    kafka_order.publish_in_order(_valid(spark, sf), "continent", lambda frame: frame.write.mode("append").parquet(path), 4, bounds, REC, KEY)
    return kafka_order.read_in_order(spark, spark.read.parquet(path), bounds)


def q_peek_sorted(spark, sf):
    v = stage(_valid(spark, sf))
    root = scratch_path(spark, "sorted")
    peeks = []
    for k in ("id", "name", "continent"):
        topic.publish_sorted(v, k, f"{root}/{k}", tiebreak=KEY)
        peeks.append(topic.peek(spark, f"{root}/{k}", PEEK_N, name=k).select("topic", "offset", "value"))
    return reduce(DataFrame.unionByName, peeks)


# ---- 2.7 streaming --------------------------------------------------------------------

EVENTS_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def q_stream_snapshot(spark, sf):
    staged = stream_snapshot(spark, sf, EVENTS_SCHEMA, glob="events.parquet")
    return with_position(staged.select("event_id", "user_id", "event_type", "ts"),
                         [F.col("ts"), F.col("event_id")], name="offset")


def _line_files(spark, sf) -> str:
    path = scratch_path(spark, "line_files")
    views.lines(spark, sf).select("value").write.option("maxRecordsPerFile", 2_000).text(path)
    return path


def q_stream_topic(spark, sf):
    """Line files streamed into a topic, a commit per batch; every batch is handed over twice."""
    path, files = scratch_path(spark, "streamed"), _line_files(spark, sf)
    again = lambda rows, number: topics.append_batch(rows, number, path, "lines")
    lines = topics.line_stream(spark, files, max_files=topics.files_per_batch(spark, files, least=BATCH_FILES))
    topics.stream_to_topic(lines, path, "lines", each=again)
    t = topic.read_topic(spark, path)
    positions = t.agg(F.count_distinct("partition", "offset")).first()[0]
    return t.select("value", F.lit(positions).alias("positions"))


def q_stream_metrics(spark, sf):
    """Counters that come with the batches of a stream of lines."""
    files = _line_files(spark, sf)
    taken = topics.files_per_batch(spark, files, least=BATCH_FILES)
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", taken).schema("value string").load(files)
    rows, listener = topics.observed_stream(parse.judge_lines(raw), topic.line_counters())
    out = scratch_path(spark, "judged_stream")
    query = (rows.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    counts = listener.totals(spark)
    spark.streams.removeListener(listener)
    names = ["read", "dropped_blank", "dropped_few_fields"]
    return literal_frame(spark, [tuple(counts[n] for n in names)], [(n, "long") for n in names])


QUERIES: dict[str, Query] = {
    "generate_people": q_generate_people,
    "csv_roundtrip": q_csv_roundtrip,
    "line_roundtrip": q_line_roundtrip,
    "read_lines": q_read_lines,
    "publish_source": q_publish_source,
    "snapshot_read": q_snapshot_read,
    "topic_stats": q_topic_stats,
    "stored_stats": q_stored_stats,
    "append_vs_replace": q_append_vs_replace,
    "publish_sorted": q_publish_sorted,
    "append_sorted": q_append_sorted,
    "publish_partitions": q_publish_partitions,
    "peek_sorted": q_peek_sorted,
    "line_filter": q_line_filter,
    "doc_line_filter": q_doc_line_filter,
    "split_limit4": q_split_limit4,
    "trim_fields": q_trim_fields,
    "strict_int": q_strict_int,
    "parse_valid": q_parse_valid,
    "parse_rejects": q_parse_rejects,
    "serialize_record": q_serialize_record,
    "key_text": q_key_text,
    "bucket_label": q_bucket_label,
    "round_robin": q_round_robin,
    "bucket_route": q_bucket_route,
    "sort_by_id": q_sort_by_id,
    "sort_by_name": q_sort_by_name,
    "sort_by_continent": q_sort_by_continent,
    "sorted_runs": q_sorted_runs,
    "merge_runs": q_merge_runs,
    "bucket_order": q_bucket_order,
    "sort_auto": q_sort_auto,
    "sort_auto_id": q_sort_auto_id,
    "global_position": q_global_position,
    "sort_all_keys": q_sort_all_keys,
    "top_n": q_top_n,
    "key_profile": q_key_profile,
    "key_sketch": q_key_sketch,
    "bucket_counts": q_bucket_counts,
    "publish_metrics": q_publish_metrics,
    "run_stats": q_run_stats,
    "check_sorted": q_check_sorted,
    "check_conserved": q_check_conserved,
    "record_differences": q_record_differences,
    "check_domains": q_check_domains,
    "stream_snapshot": q_stream_snapshot,
    "stream_topic": q_stream_topic,
    "stream_metrics": q_stream_metrics,
}
