"""Input views built from the driver's tables (people, lines, source, ...).

``people`` maps orders/customers onto the four-column record; ``lines`` serialises it
and damages some lines on purpose (by ``o_orderkey % 50``) so every parse branch is
exercised; ``hard_lines`` holds values that are hard to write as lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortpub.schema import RECORD_COLUMNS, serialize

TOPIC_PARTITIONS = 3
_INT_SPAN = 2_147_483_648  # ids stay inside int32 at any scale


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str, keep_orderkey: bool = False) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region as (id, name, address, continent)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: safe to broadcast.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    # orders x customer is planned on the plain scans (both grow with the scale factor;
    # the planner/AQE broadcasts customer only while it is small, else a sort-merge join).
    # Joining the dimension first would make the planner's product-size estimate of
    # customer x geo exceed orders and broadcast the fact table instead.
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = oc.join(F.broadcast(geo), oc.c_nationkey == geo.n_nationkey)
    cols = [
        F.pmod(F.col("o_custkey"), F.lit(_INT_SPAN)).cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderpriority")).alias("address"),
        F.col("r_name").alias("continent"),
    ]
    return j.select(*(["o_orderkey"] if keep_orderkey else []), *cols)


def damaged_line(line: Column, rec: dict[str, Column], k: Column) -> Column:
    """Line variants by k = o_orderkey % 50 (fixed rules of the test view)."""
    sid = rec["id"].cast("string")
    tail = F.concat_ws(",", rec["name"], rec["address"], rec["continent"])
    pad = F.concat(F.lit("\t\u00a0"), sid, F.lit("\u00a0,\u0085"), rec["name"], F.lit("\t,"),
                   rec["address"], F.lit("\u3000,"), rec["continent"], F.lit("\u00a0\t"))
    return (F.when(k == 0, F.lit(""))
             .when(k == 1, F.concat_ws(",", sid, rec["name"]))
             .when(k == 2, F.concat_ws(",", F.lit("3.14"), tail))
             .when(k == 3, F.concat_ws(",", F.lit("99999999999"), tail))
             .when(k == 4, F.concat(line, F.lit(", x,y ,z")))
             .when(k == 5, pad)
             .when(k == 6, F.concat(F.lit("+"), line))
             .otherwise(line))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, value): serialised people with damaged variants."""
    p = people(spark, sf_dir, keep_orderkey=True)
    rec = {c: F.col(c) for c in RECORD_COLUMNS}
    return p.select("o_orderkey", damaged_line(serialize(), rec, F.col("o_orderkey") % 50).alias("value"))


def hard_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, value): lines that begin with '#', hold U+0001, quotes, outer spaces, or a line break."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 6
    rest = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.lit("1 x"), "c_mktsegment")
    value = (F.when(k == 0, F.concat(F.lit("#"), rest)).when(k == 1, F.concat(rest, F.lit("\u0001tail")))
              .when(k == 2, F.concat(F.lit('"'), rest, F.lit('" '))).when(k == 3, F.concat(F.lit("  "), rest))
              .when(k == 4, F.concat(rest, F.lit("\n"), rest)).otherwise(rest))
    return c.select("c_custkey", value.alias("value"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, value): document texts as lines (real prose, many commas)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))


def low_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records whose *name* has few distinct values."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.pmod(F.col("p_partkey"), F.lit(_INT_SPAN)).cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", F.col("p_brand"), F.col("p_type")).alias("address"),
        F.col("p_type").alias("continent"),
        F.col("p_partkey").alias("offset"),
        F.lit(0).alias("partition"),
    )


def event_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partition, offset, value, timestamp) of events: partition = id % 3, offset = id div 3."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.expr(f"cast(pmod(event_id, {TOPIC_PARTITIONS}) as int)").alias("partition"),
        F.expr(f"event_id div {TOPIC_PARTITIONS}").alias("offset"),
        F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                    F.col("event_type")).alias("value"),
        F.col("ts").alias("timestamp"),
    )
