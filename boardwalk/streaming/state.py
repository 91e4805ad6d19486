"""What a stream's checkpoint holds in state, as DataFrames.

Reads a stopped stream's checkpoint with Spark's own state readers; the stream
itself is not needed. For the feeds' join there is state on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SIDES = {"left": "updates", "right": "status"}


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of the last batch: id, name, stores, partitions."""
    return spark.read.format("state-metadata").load(checkpoint)


def side_state(spark: SparkSession, checkpoint: str, side: str) -> DataFrame:
    """``partition_id, key, value`` of the rows that the feeds' join holds of
    one side ("updates" or "status"), with their fields."""
    rows = spark.read.format("statestore").option("joinSide", {n: s for s, n in SIDES.items()}[side]).load(checkpoint)
    return rows.select("partition_id", "key", "value")


def join_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``side, partition_id, key`` of every row that the join holds; ``key`` as
    JSON."""
    sides = [side_state(spark, checkpoint, n).select(F.lit(n).alias("side"), "partition_id", F.to_json("key").alias("key")) for n in SIDES.values()]
    return sides[0].unionByName(sides[1])


def _counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``side, partition_id, rows``: numbers of rows that add up to what the
    join holds. Where it keeps a store of how many rows each key has, that one
    alone is loaded; else (other state formats) every row is read."""
    stores = {r["stateStoreName"] for r in operators(spark, checkpoint).where("operatorId = 0").collect()}
    per = []
    for side, n in SIDES.items():
        if (name := f"{side}-keyToNumValues") in stores:
            keys = spark.read.format("statestore").option("storeName", name).load(checkpoint)
            per.append(keys.select(F.lit(n).alias("side"), "partition_id", F.col("value.value").alias("rows")))
        else:
            per.append(side_state(spark, checkpoint, n).select(F.lit(n).alias("side"), "partition_id", F.lit(1).cast("long").alias("rows")))
    return per[0].unionByName(per[1])


def state_by_partition(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``side, partition_id, rows, share``: how a side's rows are spread over
    the state partitions; ``share`` of the side's rows. State is read once."""
    per = _counts(spark, checkpoint).groupBy("side", "partition_id").agg(F.sum("rows").alias("rows"))
    # Two sides, and a row per state partition in each.
    total = F.sum("rows").over(Window.partitionBy("side"))
    return per.select("side", "partition_id", "rows", (F.col("rows") / total).alias("share"))


def hot_partitions(spark: SparkSession, checkpoint: str, times: float = 4.0) -> DataFrame:
    """The partitions that hold over ``times`` a side's mean, fullest first."""
    mean = F.avg("rows").over(Window.partitionBy("side"))
    by = state_by_partition(spark, checkpoint).withColumn("mean", mean)
    hot = by.where(F.col("rows") > F.col("mean") * times)
    return hot.drop("mean").orderBy(F.col("rows").desc(), "side", "partition_id")
