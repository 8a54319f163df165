"""Session helpers: a local session for tests/bench, and the shared scratch root.

Scratch data (staged frames, directory topics written by queries) lives under the
checkpoint directory the cluster names in ``spark.checkpoint.dir``.  A directory of
our own is created only when the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Rows beyond which a driver-side table travels as Arrow instead of literals.
LITERAL_ROWS = 8


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sortpub") -> SparkSession:
    """Session for tests and the bench; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory the session names.

    A private folder is made only when none is configured and the master is local (tests);
    on a cluster a node-local folder would hide files from the other nodes, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a directory all nodes share")
        configured = tempfile.mkdtemp(prefix="sortpub-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/sortpub-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's scratch folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex[:12]}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete one path through Hadoop's file system (used for scratch and topic roots)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application staged; frames read from it are void afterwards."""
    drop_path(spark, scratch_root(spark))


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    Cuts the lineage: later reads agree row for row, survive lost executors, and prune
    columns.  ``drop_scratch`` removes the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_frame(spark: SparkSession, rows: list[tuple], schema: list[tuple[str, str]]):
    """A small DataFrame of driver-side values, built JVM-side (no Python worker).

    ``spark.createDataFrame`` on a Python list ships the rows through a Python RDD,
    which starts Python workers in the tasks; literals avoid that, and so does an Arrow
    table, which the JVM decodes (more than ``LITERAL_ROWS`` rows; int, long and string).
    """
    from pyspark.sql import functions as F

    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in schema])
    if len(rows) > LITERAL_ROWS:
        import pyarrow as pa

        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
        table = pa.table({n: pa.array([r[i] for r in rows], kinds[t]) for i, (n, t) in enumerate(schema)})
        return spark.createDataFrame(table, ", ".join(f"{n} {t}" for n, t in schema))
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, schema)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
