"""Both feeds stored for their join: bucketed and sorted by the four trip keys.

A join of two tables bucketed alike reads bucket i of both in one task, with
no exchange. It pays where the parsed feeds are joined more than once (another
time zone, another clock, a back-fill). A bucket can't be split at run time, so
a trip with a large share of all rows is better joined by ``join_feeds`` over
plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boardwalk.operators.join import join_feeds
from boardwalk.schemas import TRIP_KEYS


def store_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """``df`` as the catalog table ``name`` over files at ``path``, a file per
    bucket: the rows are dealt out by the buckets' own hash first."""
    dealt = df.repartition(buckets, *TRIP_KEYS)
    dealt.write.bucketBy(buckets, *TRIP_KEYS).sortBy(*TRIP_KEYS).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def join_bucketed(spark: SparkSession, updates: str, status: str) -> DataFrame:
    """``join_feeds`` of two stored feeds. The merge hint keeps a small side
    from being broadcast: neither side is moved at all."""
    return join_feeds(spark.table(updates), spark.table(status).hint("merge"))
