"""The telemetry tables and how the supplied tables stand in for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packaging import ship

RECORD = "shard_id string, seq long, partition_key string, data binary"
LEASE = "shard_id string, owner string, counter long, checkpoint string, parents array<string>"
TRIM_HORIZON, SHARD_END = "TRIM_HORIZON", "SHARD_END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attrs(**values) -> F.Column:
    """A string map without the keys whose value is null."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    leaf = attrs(type=F.col("event_type"), k=F.get_json_object("props", "$.k"))
    return e.select(F.lit(0).cast("long").alias("batch_id"), F.col("user_id").alias("i"), F.lit(0).cast("long").alias("j"), F.col("event_id").alias("k"), attrs(user=F.col("user_id")).alias("res"), F.col("event_type").alias("body"), leaf.alias("attrs"), F.col("props").alias("data"))


def datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lower("l_returnflag"), F.lit("_"), F.lower("l_linestatus"))
    return x.select(F.col("l_orderkey").alias("batch_id"), F.col("l_suppkey").alias("i"), attrs(supp=F.col("l_suppkey")).alias("res"), name.alias("metric"), F.lit("gauge").alias("kind"), F.col("l_extendedprice").alias("double_value"), attrs(part=F.col("l_partkey")).alias("attrs"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, x = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    both = o.join(x, o["o_orderkey"] == x["l_orderkey"])
    return both.select(F.lit(0).cast("long").alias("batch_id"), F.col("o_custkey").alias("i"), F.lit(0).cast("long").alias("j"), F.col("l_orderkey").alias("trace"), F.col("l_linenumber").alias("span"), F.col("o_orderpriority").alias("name"), attrs(cust=F.col("o_custkey")).alias("res"), attrs(flag=F.col("l_returnflag")).alias("attrs"))


def leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as shards under regions, with an owner, its freshness and its checkpoint."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_regionkey").alias("parent"))
    child = n.select(
        F.format_string("shard-%03d", F.col("key")).alias("shard_id"),
        F.when(F.col("key") % 4 == 0, "").otherwise(F.concat(F.lit("w"), F.col("key") % 4)).alias("owner"),
        F.col("key").alias("counter"),
        F.when(F.col("key") % 6 == 5, SHARD_END).otherwise(TRIM_HORIZON).alias("checkpoint"),
        F.array(F.format_string("region-%d", F.col("parent"))).alias("parents"),
        ((F.col("key") % 4 != 0) & (F.col("key") % 5 != 0)).alias("fresh"),
    )
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("key"))
    top = r.select(F.format_string("region-%d", F.col("key")).alias("shard_id"), F.lit("").alias("owner"), F.col("key").alias("counter"), F.when(F.col("key") % 2 == 0, SHARD_END).otherwise(TRIM_HORIZON).alias("checkpoint"), F.array().cast("array<string>").alias("parents"), F.lit(False).alias("fresh"))
    return child.unionByName(top)
