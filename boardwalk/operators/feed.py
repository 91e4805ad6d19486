"""Feed intake: split polled documents into the two message kinds, and merge
the route-group feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.functions import compact_json
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC


def split_feed(snapshots: DataFrame) -> DataFrame:
    """Documents ``(value, ingest_ts)`` holding ``{"entity": [...]}`` to
    messages ``topic, key, value, ingest_ts``.

    An entity with a trip update gives an update message; one with a vehicle
    gives a status message; one with both gives both. Each part is serialised
    to JSON and compacted. One pass: the documents are parsed and exploded
    once, and the output is routed by its ``topic`` column (the Kafka sink
    writes each row to the topic it names)."""
    doc = F.from_json(F.col("value").cast("string"), schemas.FEED_SNAPSHOT)
    e = snapshots.select(F.explode(doc["entity"]).alias("e"), "ingest_ts")
    parts = F.array(
        F.when(
            F.col("e.tripUpdate").isNotNull(),
            F.struct(
                F.lit(UPDATES_TOPIC).alias("topic"),
                F.col("e.tripUpdate.trip.tripId").alias("key"),
                F.to_json("e.tripUpdate").alias("json"),
            ),
        ),
        F.when(
            F.col("e.vehicle").isNotNull(),
            F.struct(
                F.lit(STATUS_TOPIC).alias("topic"),
                F.col("e.vehicle.trip.tripId").alias("key"),
                F.to_json("e.vehicle").alias("json"),
            ),
        ),
    )
    return (
        e.select(F.explode(parts).alias("p"), "ingest_ts")
        .where(F.col("p").isNotNull())
        .select("p.topic", "p.key", compact_json("p.json").alias("value"), "ingest_ts")
    )


def topic(messages: DataFrame, name: str) -> DataFrame:
    """The envelopes of one topic from a routed message frame."""
    return messages.where(F.col("topic") == F.lit(name)).select("key", "value", "ingest_ts")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Union-all of several feeds of the same shape (by column name)."""
    if not feeds:
        raise ValueError("union_feeds needs at least one feed")
    return reduce(lambda a, b: a.unionByName(b), feeds)
