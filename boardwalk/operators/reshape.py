"""Reshape parsed messages into join-ready rows.

The stop list is reduced to the five values the board needs (count, first and
last stop, first and last arrival) *before* the join: arrays never cross the
join's shuffle and never sit in streaming join state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.functions import epoch_text_to_utc, first_item, last_item, normalise_status, stop_count


def reshape_updates(parsed: DataFrame) -> DataFrame:
    arrivals = F.col("stopTimeUpdate.arrival.time")
    stop_ids = F.col("stopTimeUpdate.stopId")
    return parsed.select(
        "tripId",
        "routeId",
        "startTime",
        "startDate",
        stop_count(arrivals).alias("numOfFutureStops"),
        first_item(arrivals).alias("nextArrival"),
        first_item(stop_ids).alias("nextStopId"),
        last_item(arrivals).alias("lastArrival"),
        last_item(stop_ids).alias("lastStopId"),
        "u_ingest_ts",
        "u_hash",
    )


def reshape_status(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "tripId",
        "routeId",
        "startTime",
        "startDate",
        "currentStopSequence",
        normalise_status("currentStatus").alias("currentStatus"),
        F.col("stopId").alias("currentStopId"),
        epoch_text_to_utc("timestamp").alias("s_event_ts"),
        "s_ingest_ts",
        "s_hash",
    )
