"""Plan shape: no full-data single-partition step, pushdown and pruning reach the scan."""

import re

from sortpub.operators import order
from sortpub.plans import views
from sortpub.sources import topic
from tests.conftest import SF, people_df


def test_total_order_single_partition_only_over_counts(spark):
    df = people_df(spark, [(i % 50, f"n{i}", "a", "Asia") for i in range(2000)], 4)
    out = order.total_order(df, "name")
    out.write.format("noop").mode("overwrite").save()
    text = out._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchange feeds the prefix sum over the per-partition counts
    lines = text.splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles, text
    for i in singles:
        below = "\n".join(lines[i + 1:i + 4])
        assert "HashAggregate" in below or "count" in below, below
    assert "Window [row_number()" not in text


def test_snapshot_bounds_reach_the_scan(spark, tmp_out):
    topic.write_topic(views.event_topic(spark, SF), tmp_out)
    df = topic.snapshot_read(spark, tmp_out, [(0, 0, 10), (1, 0, 10)]).select("offset", "value")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*partition", text), text
    assert re.search(r"PushedFilters: \[.*LessThan\(offset,10\)", text), text
    # column pruning: the timestamp column is not read
    assert "timestamp" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_checks_read_their_input_once(spark, tmp_out):
    from sortpub.operators import verify

    topic.publish_sorted(people_df(spark, [(i % 50, f"n{i}", "a", "Asia") for i in range(500)], 4), "name", tmp_out)
    out = verify.check_sorted(topic.read_topic(spark, tmp_out), "value")
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1, text


def test_no_range_sort_where_no_position_is_needed(spark):
    from sortpub.plans.queries import QUERIES

    for name in ("parse_valid", "key_text", "bucket_counts", "check_domains", "bucket_label"):
        text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "LogicalRDD" not in text, name


def test_no_persisted_frames_are_left(spark):
    from sortpub.plans.queries import QUERIES

    for name in ("sort_by_name", "sort_all_keys", "key_profile", "publish_sorted"):
        QUERIES[name](spark, SF).count()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_people_view_broadcasts_only_fixed_dimensions(spark):
    text = views.people(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # explicit hints only on nation/region; orders/customer strategy is left to the planner
    hints = text.count("strategy=broadcast")
    assert hints <= 2, text
