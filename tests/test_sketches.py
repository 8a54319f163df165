"""Distinct-key sketches and statistics that come from what a topic stores about its files."""

import random

import pytest

from sortpub.sources import manifest, sketches, topic
from tests.conftest import lines_df, people_df


def people(n, seed, low=0):
    rng = random.Random(seed)
    return [(rng.randrange(low, low + 3 * n), f"n{rng.randrange(n)}", "a", rng.choice(["Asia", "Europe", "Africa"])) for _ in range(n)]


def exact(rows):
    return {"id": len({r[0] for r in rows}), "name": len({r[1] for r in rows}), "continent": len({r[3] for r in rows})}


def check(spark, path, rows):
    got = {r["sort_key"]: r for r in sketches.key_estimates(spark, path).collect()}
    assert set(got) == {"id", "name", "continent"}
    for k, n in exact(rows).items():
        assert got[k]["rows"] == len(rows) and abs(got[k]["distinct_keys"] - n) <= 0.05 * n, k


def test_sketches_follow_arrival_appends(spark, tmp_out):
    a, b = people(3000, 1), people(2000, 2, low=5000)
    text = lambda rows: lines_df(spark, [",".join(map(str, r)) for r in rows])
    topic.publish_lines(text(a), tmp_out, 3)
    first = len({r["path"] for r in manifest.read(spark, tmp_out).collect()})
    assert sketches.update(spark, tmp_out) == first and sketches.update(spark, tmp_out) == 0
    check(spark, tmp_out, a)
    topic.publish_lines(text(b), tmp_out, 3, mode="append")
    with pytest.raises(Exception, match="without a sketch"):
        sketches.key_estimates(spark, tmp_out).collect()
    whole = len({r["path"] for r in manifest.read(spark, tmp_out).collect()})
    assert sketches.update(spark, tmp_out) == whole - first          # only the append's own files
    check(spark, tmp_out, a + b)
    topic.publish_lines(text(b), tmp_out, 3, mode="overwrite")
    sketches.update(spark, tmp_out)
    check(spark, tmp_out, b)


def test_sketches_follow_merged_shards(spark, tmp_out):
    a, b = people(2000, 3), people(500, 4, low=1000)
    topic.publish_sorted(people_df(spark, a), "id", tmp_out)
    sketches.update(spark, tmp_out)
    topic.publish_sorted(people_df(spark, b), "id", tmp_out, mode="append")
    sketches.update(spark, tmp_out)
    check(spark, tmp_out, a + b)


def test_sketches_of_an_empty_topic(spark, tmp_out):
    topic.publish_lines(lines_df(spark, ["1,a,b,Asia"]).where("false"), tmp_out, 3)
    assert sketches.update(spark, tmp_out) == 0 and sketches.key_estimates(spark, tmp_out).count() == 0
    assert topic.stored_stats(spark, tmp_out).count() == 0


def test_stored_stats_equal_the_scan(spark, tmp_out):
    rows = [",".join(map(str, r)) for r in people(700, 5)]
    topic.publish_lines(lines_df(spark, rows), tmp_out, 3)
    topic.publish_lines(lines_df(spark, rows[:100]), tmp_out, 3, mode="append")
    want = topic.topic_stats(topic.read_topic(spark, tmp_out, "t"))
    got = topic.stored_stats(spark, tmp_out, "t")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert not any(f"/{manifest.DATA}/" in f for f in got.inputFiles())
