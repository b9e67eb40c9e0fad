"""Flow-shaped views over the driver's tables, one text for Spark and for the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FLOWS = """
select o_orderkey as flow_id,
 o_orderpriority as label,
 o_orderdate as flow_ts,
 case cast(o_orderkey % 10 as int) when 0 then 0 when 1 then 6 when 2 then 6 when 3 then 6 else 17 end as protocol,
 case when o_orderkey % 53 = 0 then null when o_orderkey % 59 = 0 then 'abc'
  else concat_ws('.', case cast(o_custkey % 4 as int) when 0 then '172' when 1 then '192' when 2 then '10' else '8' end,
   case when o_custkey % 8 = 1 then '168' else cast(o_custkey % 48 as varchar(10)) end,
   cast(o_custkey % 256 as varchar(10)), cast(o_orderkey % 256 as varchar(10))) end as source_ip,
 case cast(o_orderkey % 14 as int) when 0 then 80 when 1 then 443 when 2 then 137 when 3 then 22 when 4 then 21
  when 5 then 389 when 6 then 123 when 7 then 53 when 8 then 88 when 9 then 465 when 10 then 135
  when 11 then 5353 when 12 then 50000 else null end as source_port,
 case when o_orderkey % 97 = 0 then cast('Infinity' as double)
  when o_orderkey % 89 = 0 then cast(null as double) else o_totalprice end as flow_bytes_s,
 7 as const_col
from {orders}
"""

# The same flows in the shape of the capture files: ports are always known, both ends listed.
CAPTURES = """
select flow_id as row_no,
 concat_ws('-', source_ip, cast(flow_id as varchar(20))) as flow_name,
 source_ip,
 coalesce(source_port, 40000) as source_port,
 concat_ws('.', '192', case when flow_id % 3 = 0 then '168' else '20' end, '1', cast(flow_id % 200 as varchar(10))) as destination_ip,
 case cast(flow_id % 6 as int) when 0 then 80 when 1 then 445 when 2 then 3268 when 3 then 8080 else 1024 end as destination_port,
 protocol,
 flow_ts,
 flow_bytes_s,
 case when flow_id % 83 = 0 then cast(null as double) else flow_bytes_s / 1024 end as flow_packets_s,
 const_col,
 'no' as similar_http,
 label
from ({flows}) f
"""

CAPTURE_NAMES = [
    "row_no", "flow_name", "source_ip", "source_port", "destination_ip", "destination_port", "protocol",
    "flow_ts", "flow_bytes_s", "flow_packets_s", "const_col", "similar_http", "label",
]

# Header spellings of the capture files, in the order of CAPTURES.
CAPTURE_HEADERS = [
    "Unnamed: 0", "Flow ID", " Source IP", " Source Port", " Destination IP", " Destination Port",
    " Protocol", " Timestamp", "Flow Bytes/s", " Flow Packets/s", " Bulk Rate", "SimilarHTTP", " Label",
]

SCORED = """
select o_orderkey as row_id, cast(o_orderkey % 5 as int) as label,
 case when o_custkey % 4 = 0 then cast(o_custkey % 5 as int) else cast(o_orderkey % 5 as int) end as pred,
 cast((o_orderkey * 7 + o_custkey) % 100 as double) / 100 as s0,
 cast((o_orderkey * 7 + o_custkey * 2) % 100 as double) / 100 as s1,
 cast((o_orderkey * 7 + o_custkey * 3) % 100 as double) / 100 as s2,
 cast((o_orderkey * 7 + o_custkey * 4) % 100 as double) / 100 as s3,
 cast((o_orderkey * 7 + o_custkey * 6) % 100 as double) / 100 as s4
from {orders}
"""

SCORES = ["s0", "s1", "s2", "s3", "s4"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLOWS, orders=table(spark, sf_dir, "orders"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows under the capture headers."""
    text = CAPTURES.format(flows=FLOWS)
    return spark.sql(text, orders=table(spark, sf_dir, "orders")).toDF(*CAPTURE_HEADERS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED, orders=table(spark, sf_dir, "orders"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def wide_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, e0..``: the embedding as one double column per dimension of the data."""
    df = vectors(spark, sf_dir)
    ends = df.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    if ends.least != ends.most:
        raise ValueError(f"vectors of {ends.least} to {ends.most} dimensions")
    width = ends.most or 0
    return df.select(
        "vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(width)]
    )


def sql(text: str) -> str:
    """A view's text for a database in which the driver's tables are views."""
    return text.format(orders="orders", flows=FLOWS.format(orders="orders"))
