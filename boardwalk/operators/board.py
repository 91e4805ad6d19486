"""Derive the trip board from joined rows: one ``select``, built-in
expressions only, so Catalyst collapses it into the join's codegen stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.functions import clock_time, instant_to_utc, start_time, stop_time
from boardwalk.functions.timefn import FEED_SOURCE_TZ, REFERENCE, REFERENCE_SHIFT_TZ


def clock_column(df: DataFrame, clock: Column | str | None) -> Column:
    """The clock as UTC wall time. ``None`` is the query's current time
    (constant within a micro-batch); a column name or expression is used as
    given, an instant converted to its UTC wall time."""
    c = F.current_timestamp() if clock is None else (F.col(clock) if isinstance(clock, str) else clock)
    dtype = df.select(c.alias("_c")).schema["_c"].dataType
    if isinstance(dtype, T.TimestampType):
        return instant_to_utc(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    raise TypeError(f"clock must be a timestamp, got {dtype.simpleString()}")


def derive_board(
    joined: DataFrame,
    mode: str = REFERENCE,
    clock: Column | str | None = None,
    shift_tz: str = REFERENCE_SHIFT_TZ,
    source_tz: str = FEED_SOURCE_TZ,
    keep_order: bool = False,
) -> DataFrame:
    """The 12 board columns (``schemas.BOARD_COLUMNS``). With ``keep_order``
    the ordering columns used by the upsert (``schemas.LATEST_ORDER``) follow
    them."""
    now = clock_column(joined, clock) if "currentTime" not in joined.columns else None
    cols = [
        F.col("tripId"),
        F.col("routeId"),
        start_time("startDate", "startTime", mode, shift_tz, source_tz).alias("startTime"),
        F.col("numOfFutureStops").cast("int").alias("numOfFutureStops"),
        F.col("currentStopSequence"),
        F.col("currentStatus"),
        F.col("currentStopId"),
        stop_time("nextArrival", mode, shift_tz).alias("nextStopArrivalTime"),
        F.col("nextStopId"),
        stop_time("lastArrival", mode, shift_tz).alias("lastStopArrivalTime"),
        F.col("lastStopId"),
        (F.col("currentTime") if now is None else clock_time(now, mode, shift_tz)).alias("currentTime"),
    ]
    if keep_order:
        cols += [F.col(c) for c in schemas.LATEST_ORDER if c != "currentTime"]
    return joined.select(*cols)
