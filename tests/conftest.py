import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("sortpub-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sortpub-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_out(spark):
    from sortpub.session import scratch_path

    return scratch_path(spark, "t")


def lines_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def people_df(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, "id int, name string, address string, continent string")
    return df.repartition(partitions) if partitions else df
