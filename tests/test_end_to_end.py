"""Whole flow on a small input: publish, snapshot, parse once, every key, checks."""

from sortpub.plans import end_to_end
from sortpub.sources import topic


def test_flow_with_malformed_lines(spark, tmp_out):
    good = [f"{i % 13},Name{i % 7},{i} Road,{['Asia', 'Europe', 'North America'][i % 3]}" for i in range(60)]
    odd = ["7,Comma,1 a,b,c,d", '8,Q"uote,2 b,Asia', "  9 , Pad , 3 c , Africa  "]
    bad = ["", "x,y", "notanumber,a,b,c", "99999999999,a,b,c"]
    vals = good + odd + bad
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, value string")
    res = end_to_end.run(spark, lines, tmp_out, order=["k"])
    assert res["publish"]["sent"] == len(vals) - 2          # '' and 'x,y' never published
    checks = end_to_end.check_outputs(spark, f"{tmp_out}/source", tmp_out)
    for key, c in checks.items():
        assert c["sorted"] and not c["position_gaps"], key
        assert c["rows_in"] == c["rows_out"] == len(good) + len(odd), key
        assert c["missing"] == 0 and c["extra"] == 0 and c["fingerprint_equal"], key
    rejects = spark.read.parquet(f"{tmp_out}/_rejects").collect()
    assert sorted(r.reject_reason for r in rejects) == ["bad_id", "bad_id"]
    first = topic.peek(spark, f"{tmp_out}/continent", 1).first()
    assert first.value.endswith(",Africa") and first.offset == 0
    comma = topic.read_topic(spark, f"{tmp_out}/id").where("value like '7,Comma,%'").first()
    assert comma.value == "7,Comma,1 a,b,c,d"


def test_rerun_replaces_outputs(spark, tmp_out):
    lines = spark.createDataFrame([(i, f"{i},n{i},a,Asia") for i in range(10)], "k long, value string")
    end_to_end.run(spark, lines, tmp_out, order=["k"])
    end_to_end.run(spark, lines, tmp_out, order=["k"])
    for key in ("id", "name", "continent"):
        assert topic.read_topic(spark, f"{tmp_out}/{key}").count() == 10
