"""The latest row per trip as a streaming aggregation.

State holds the best row of each trip so far; a micro-batch passes on only the
trips whose best row came with that very batch. A repeated or older row changes
nothing and writes nothing, where ``write_upsert`` alone would write the
batch's best row again.

The aggregation stands behind the board's append sink, in a stream of its own:
Spark lets no updating aggregation follow a stream-stream join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardwalk import schemas
from boardwalk.streaming.sinks import write_upsert

def latest_changes(rows: DataFrame, key: str = "tripId", order: list[str] | None = None, expire: str | None = None) -> DataFrame:
    """Of a stream of board rows with their order columns, in update mode: each
    trip's best row when it has just become that.

    With ``expire`` (an interval), state goes once the feed has moved on by
    that much past a trip's start time (its clock, where it has none); rows
    that come later still are dropped. A trip's state is then kept per start
    time, and the table behind decides between starts. Without it, state grows
    with the trips."""
    order = order or schemas.LATEST_ORDER
    names = rows.columns
    now = F.unix_micros(F.current_timestamp())
    keys = [key]
    rows = rows.withColumn("_seen", now)
    if expire:
        start = F.coalesce("startTime", "currentTime").cast("timestamp")
        rows = rows.withColumn("_start", start).withWatermark("_start", expire)
        keys.append("_start")
    # Of equal rows the one seen first is best: a repetition changes nothing.
    best = F.max_by(F.struct(*[c for c in names if c != key], "_seen"), F.struct(*order, (-F.col("_seen")).alias("_first")))
    found = rows.groupBy(*keys).agg(best.alias("_r"))
    return found.where(F.col("_r._seen") == now).select(key, "_r.*").select(*names)


def write_latest(
    rows: DataFrame, path: str, checkpoint: str, key: str = "tripId", order: list[str] | None = None, expire: str | None = None, **how
) -> StreamingQuery:
    """Keeps the latest row per trip at ``path`` from a stream of board rows
    (``write_upsert`` of ``latest_changes``)."""
    return write_upsert(latest_changes(rows, key, order, expire), path, checkpoint, key, order, output_mode="update", **how)
