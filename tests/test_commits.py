"""Topics as commits: replace from itself, crashes, writers at once, versions, ordered appends."""

import random

import pytest
from pyspark.sql import functions as F

from sortpub.operators import parse, verify
from sortpub.operators.order import sort_columns
from sortpub.sources import manifest, ordered, topic
from tests.conftest import lines_df, people_df


def lines_of(n, start=0):
    return [f"{i},n{i},a,Asia" for i in range(start, start + n)]


def values(spark, path, version=None):
    return sorted(r.value for r in topic.read_topic(spark, path, version=version).collect())


def test_topic_replaced_from_itself(spark, tmp_out):
    topic.publish_lines(lines_df(spark, lines_of(100)), tmp_out, 3)
    m = topic.publish_lines(topic.read_topic(spark, tmp_out).where("offset < 20"), tmp_out, 3)
    assert m["sent"] == 60 and topic.read_topic(spark, tmp_out).count() == 60
    topic.publish_sorted(parse.valid(parse.parse(topic.read_topic(spark, tmp_out))), "id", tmp_out)
    assert [r.value for r in topic.read_topic(spark, tmp_out).orderBy("offset").limit(3).collect()] == lines_of(3)


def test_a_failed_write_leaves_the_topic_as_it_was(spark, tmp_out):
    topic.publish_lines(lines_df(spark, lines_of(50)), tmp_out, 3)
    broken = lines_df(spark, lines_of(50)).withColumn("value", F.when(F.col("value") == "49,n49,a,Asia", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            topic.publish_lines(broken, tmp_out, 3, mode=mode)
        assert values(spark, tmp_out) == sorted(lines_of(50)) and manifest.versions(spark, tmp_out) == [0]


def test_data_without_a_commit_is_not_there(spark, tmp_out, monkeypatch):
    """Files written, manifest not: the next append starts at the committed mark and no position is doubled."""
    topic.publish_lines(lines_df(spark, lines_of(100)), tmp_out, 3)
    real = manifest.commit

    def crash(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "commit", crash)
    with pytest.raises(KeyboardInterrupt):
        topic.publish_lines(lines_df(spark, lines_of(9, 100)), tmp_out, 3, mode="append")
    monkeypatch.setattr(manifest, "commit", real)
    assert topic.read_topic(spark, tmp_out).count() == 100
    topic.publish_lines(lines_df(spark, lines_of(9, 200)), tmp_out, 3, mode="append")
    t = topic.read_topic(spark, tmp_out)
    assert values(spark, tmp_out) == sorted(lines_of(100) + lines_of(9, 200))
    assert t.select("partition", "offset").distinct().count() == 109 == topic.snapshot_read(spark, tmp_out).count()


def test_two_writers_at_once(spark, tmp_out):
    topic.publish_lines(lines_df(spark, lines_of(10)), tmp_out, 3)
    base = manifest.latest(spark, tmp_out)
    rows = manifest.read(spark, tmp_out, base)
    topic.publish_lines(lines_df(spark, lines_of(5, 50)), tmp_out, 3, mode="append")
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, tmp_out, rows, base)
    assert topic.read_topic(spark, tmp_out).count() == 15 and manifest.versions(spark, tmp_out) == [0, 1]


def test_versions_and_vacuum(spark, tmp_out):
    topic.publish_lines(lines_df(spark, lines_of(10)), tmp_out, 2)
    topic.publish_lines(lines_df(spark, lines_of(4, 10)), tmp_out, 2, mode="append")
    topic.publish_lines(lines_df(spark, lines_of(3, 90)), tmp_out, 2)
    assert [len(values(spark, tmp_out, v)) for v in (0, 1, 2)] == [10, 14, 3]
    assert topic.read_manifest(spark, tmp_out, 1) == [(0, 0, 7, 7), (1, 0, 7, 7)]
    assert manifest.vacuum(spark, tmp_out, keep=2) == [] and manifest.versions(spark, tmp_out) == [1, 2]
    assert len(manifest.vacuum(spark, tmp_out)) == 2 and values(spark, tmp_out) == sorted(lines_of(3, 90))


def test_a_batch_is_committed_once(spark, tmp_out):
    for _ in range(2):
        topic.publish_lines(lines_df(spark, lines_of(6)), tmp_out, 3, mode="append", batch="s:0")
    topic.publish_lines(lines_df(spark, lines_of(6)), tmp_out, 3, mode="append", batch="s:1")
    assert topic.read_topic(spark, tmp_out).count() == 12


def test_folder_without_manifest(spark, tmp_out):
    spark.range(0, 30).select(F.lit("x").alias("value"), F.col("id").alias("offset"), F.lit(0).alias("partition")).write.parquet(tmp_out)
    assert topic.read_manifest(spark, tmp_out) == [(0, 0, 30, 30)] and topic.read_topic(spark, tmp_out).count() == 30
    with pytest.raises(ValueError):
        topic.publish_lines(lines_df(spark, lines_of(3)), tmp_out, 3, mode="append")


# -- ordered topics ------------------------------------------------------------------------

def in_order(spark, path, key, want):
    """The topic holds ``want`` (records) at offsets 0..N-1 in the order of key and rest."""
    back = parse.valid(parse.parse(topic.read_topic(spark, path), keep=["offset"]), keep=["offset"])
    row = verify.check_sorted(back, key).first()
    assert row["sorted"] and row["rows"] == len(want)
    cols = ["id", "name", "address", "continent"]
    order = [cols.index(c) for c in sort_columns(back.select(*cols), key, cols)]
    got = [tuple(r)[1:] for r in back.select("offset", *cols).orderBy("offset").collect()]
    assert got == sorted(want, key=lambda r: [r[i] for i in order])


@pytest.mark.parametrize("key", ["id", "name"])
def test_random_appends_keep_the_order(spark, tmp_out, key, monkeypatch):
    rng = random.Random(key)
    rows = [(rng.randrange(-50, 400), f"n{rng.randrange(60):02d}", "a b", rng.choice(["Asia", "Africa"])) for _ in range(900)]
    cuts = [0, 300, 310, 311, 311, 700, 900]
    monkeypatch.setattr(ordered, "range_partitions", lambda df: 5)
    for a, b in zip(cuts, cuts[1:]):
        part = people_df(spark, rows[a:b] or rows[:1]).limit(b - a)
        m = topic.publish_sorted(part, key, tmp_out, mode="append" if a else "overwrite")
        assert m["sent"] == b - a
        in_order(spark, tmp_out, key, rows[:b])
    hwm = topic.capture_bounds(spark, tmp_out)
    assert hwm == [(0, 0, 900)]
    assert [r.offset for r in topic.peek(spark, tmp_out, 7).orderBy("offset").collect()] == list(range(7))


def test_append_reads_only_overlapping_shards(spark, tmp_out):
    rows = [(i * 10, f"n{i}", "a", "Asia") for i in range(800)]
    topic.publish_sorted(people_df(spark, rows), "id", tmp_out)
    old = {r["path"]: r for r in manifest.read(spark, tmp_out).collect()}
    zones = sorted((int(r["first_key"]), int(r["last_key"]), p) for p, r in old.items())
    assert len(zones) >= 3
    inside = zones[1][0] + 1                                    # in the second shard's range only
    more = [(inside, "new", "b", "Asia"), (zones[-1][1] + 5, "end", "b", "Asia"), (-7, "start", "b", "Asia")]
    topic.publish_sorted(people_df(spark, more), "id", tmp_out, mode="append")
    new = {r["path"]: r for r in manifest.read(spark, tmp_out).collect()}
    assert set(old) - set(new) == {zones[1][2]}
    # The others are listed again as they are, at offsets moved by the records before them.
    for lo, _, path in zones:
        if path != zones[1][2]:
            assert new[path]["oldest"] - old[path]["oldest"] == sum(m[0] < lo for m in more)
    in_order(spark, tmp_out, "id", rows + more)
    untouched = [p for _, _, p in zones if p in new]
    plan = topic.snapshot_read(spark, tmp_out, [(0, new[untouched[-1]]["oldest"], new[untouched[-1]]["hwm"])])
    assert len(plan.inputFiles()) == 1


def test_append_with_hot_and_null_keys(spark, tmp_out):
    first = people_df(spark, [(i, "same", "a", "Asia") for i in range(300)])
    topic.publish_sorted(first, "name", tmp_out)
    more = people_df(spark, [(i, n, "b", "Asia") for i, n in enumerate(["same"] * 50 + ["a", "z"])])
    topic.publish_sorted(more.withColumn("name", F.when(F.col("name") != "a", F.col("name"))), "name", tmp_out, mode="append")
    got = [r.value for r in topic.read_topic(spark, tmp_out).orderBy("offset").collect()]
    assert got[0] == "50,b,Asia" and got[-1] == "51,z,b,Asia" and len(got) == 352
    assert got[1:-1] == [f"{i},same,{a},Asia" for i, a in sorted([(i, "a") for i in range(300)] + [(i, "b") for i in range(50)])]


def test_append_needs_the_same_order(spark, tmp_out):
    df = people_df(spark, [(1, "n", "a", "Asia")])
    topic.publish_sorted(df, "id", tmp_out)
    with pytest.raises(ValueError):
        topic.publish_sorted(df, "name", tmp_out, mode="append")
    with pytest.raises(ValueError):
        topic.publish_sorted(df.select("id", "name"), "id", tmp_out, mode="append")


def test_empty_appends(spark, tmp_out):
    none = people_df(spark, [(1, "n", "a", "Asia")]).where("false")
    topic.publish_sorted(none, "id", tmp_out)
    assert topic.read_topic(spark, tmp_out).count() == 0
    topic.publish_sorted(people_df(spark, [(2, "n", "a", "Asia"), (1, "n", "a", "Asia")]), "id", tmp_out, mode="append")
    topic.publish_sorted(none, "id", tmp_out, mode="append")
    in_order(spark, tmp_out, "id", [(1, "n", "a", "Asia"), (2, "n", "a", "Asia")])
