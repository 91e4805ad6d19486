"""Latest row per key: the state an upsert sink holds.

``latest_per_key`` is one aggregation, ``max_by(row, order)`` per key, which
Spark runs as a partial aggregate before the shuffle and a final one after:
a key holding a third of all rows is reduced inside every map task first, so
no task ever holds its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.operators.board import clock_column, derive_board
from boardwalk.operators.join import join_feeds
from boardwalk.functions import clock_time
from boardwalk.functions.timefn import FEED_SOURCE_TZ, REFERENCE, REFERENCE_SHIFT_TZ


def latest_per_key(df: DataFrame, key: list[str] | str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` (compared as a
    tuple, left to right). Column order is kept."""
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key).agg(best.alias("_r")).select(*key, "_r.*").select(*df.columns)


def latest_board(
    updates: DataFrame,
    status: DataFrame,
    mode: str = REFERENCE,
    clock: Column | str | None = None,
    shift_tz: str = REFERENCE_SHIFT_TZ,
    source_tz: str = FEED_SOURCE_TZ,
    key: str = "tripId",
    keep_order: bool = False,
) -> DataFrame:
    """Latest board row per ``key`` without forming every update x status
    pair first.

    The board order (``schemas.LATEST_ORDER``) is lexicographic over
    ``(currentTime, status time, update ingest, status ingest, update hash,
    status hash)``. When the clock depends only on the update (or is
    constant), the best pair of a trip is (best update, best status), each by
    its own part of that order. So both sides are reduced per trip key before
    the join (partial aggregation, a 1:1 join after), and the best trip-key
    group wins per ``key``. Equal to ``latest_per_key(board, key, order)``
    over the full many-to-many join, at the cost of two aggregations.
    """
    now = clock_column(updates, clock)
    u = updates.withColumn("currentTime", clock_time(now, mode, shift_tz))
    u = latest_per_key(u, schemas.TRIP_KEYS, ["currentTime", *schemas.UPDATE_ORDER])
    s = latest_per_key(status, schemas.TRIP_KEYS, schemas.STATUS_ORDER)
    board = derive_board(join_feeds(u, s), mode=mode, shift_tz=shift_tz, source_tz=source_tz, keep_order=True)
    best = latest_per_key(board, key, schemas.LATEST_ORDER)
    return best if keep_order else best.select(*schemas.BOARD_COLUMNS)
