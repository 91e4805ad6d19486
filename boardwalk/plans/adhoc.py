"""The nine questions asked of the board. Each takes the board (any
DataFrame with the board's columns: the append folder, the upsert table or a
live plan) and returns a DataFrame.

Where the two SQL dialects of the original differ, both are here: minutes
until the next stop as elapsed minutes or as minute boundaries crossed.
The first-snapshot question (rank 1 by clock) is asked as a minimum filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.functions import minute_boundaries, minutes_elapsed
from boardwalk.operators.rank import global_rank
from boardwalk.schemas import BOARD_COLUMNS

# The interval of the original's "trips started between" query.
Q5_FROM = "2022-10-12 00:00:00"
Q5_TO = "2022-10-18 18:00:00"
Q3_ROWS = 10


def q1_all(board: DataFrame) -> DataFrame:
    """The whole board."""
    return board.select(*BOARD_COLUMNS)


def q2_count(board: DataFrame) -> DataFrame:
    """Number of entries: non-null trip ids (partial counts, one tiny final)."""
    return board.agg(F.count("tripId").alias("numOfTrips"))


def q3_first_rows(board: DataFrame, n: int = Q3_ROWS) -> DataFrame:
    """The non-metadata fields, ``n`` rows. The original takes any ``n``;
    ordering by all fields makes the result repeatable. Spark plans it as a
    top-k (each task keeps ``n`` rows), not a sort of the board."""
    cols = BOARD_COLUMNS[:-1]
    return board.select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


def q4_trips_per_route(board: DataFrame) -> DataFrame:
    return (
        board.groupBy("routeId")
        .agg(F.count("tripId").alias("numOfTrips"))
        .orderBy(F.col("routeId").asc_nulls_last())
    )


def q5_started_between(board: DataFrame, lo: str = Q5_FROM, hi: str = Q5_TO) -> DataFrame:
    """Trips per route and start time for starts in ``[lo, hi]``; the start
    time is a group key but not shown, as in the original."""
    lo_ts = F.lit(lo).cast("timestamp_ntz")
    hi_ts = F.lit(hi).cast("timestamp_ntz")
    return (
        board.where(F.col("startTime").between(lo_ts, hi_ts))
        .groupBy("routeId", "startTime")
        .agg(F.count("tripId").alias("numOfTrips"))
        .select("numOfTrips", "routeId")
        .orderBy(F.col("numOfTrips").desc())
    )


def q6_current_and_next(board: DataFrame) -> DataFrame:
    # The columns asked for.
    return board.select("tripId", "routeId", "currentStopSequence", "currentStatus", "currentStopId", "nextStopId")


def _q7(board: DataFrame, minutes) -> DataFrame:
    """The minutes come out of a one-row generator over the board's columns,
    so the ``>= 0`` filter stays above it: pushed below the board's
    projection it would inline the time expressions several times into a
    filter, which gets no common-subexpression pass (measured 30 % slower on
    the live board). On a board table both forms read the same columns."""
    m = minutes(F.col("currentTime"), F.col("nextStopArrivalTime"))
    row = F.struct(F.col("tripId"), F.col("routeId"), m.alias("minutesRemainingUntilNextStop"))
    return board.select(F.inline(F.array(row))).where(F.col("minutesRemainingUntilNextStop") >= 0)


def q7_minutes_to_next(board: DataFrame) -> DataFrame:
    """Whole minutes until the next arrival, kept when >= 0."""
    return _q7(board, minutes_elapsed)


def q7_minutes_boundary(board: DataFrame) -> DataFrame:
    """Minute boundaries until the next arrival, kept when >= 0."""
    return _q7(board, minute_boundaries)


def q8_last_stop(board: DataFrame) -> DataFrame:
    # The columns asked for.
    return board.select("tripId", "routeId", "lastStopId", "lastStopArrivalTime")


def _q9_sum(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("tripId", "routeId", "currentTime")
        .agg(F.sum("numOfFutureStops").alias("numOfFutureStops"))
        .orderBy(F.col("numOfFutureStops").desc())
    )


def q9_first_snapshot(board: DataFrame, clocks: DataFrame | None = None) -> DataFrame:
    """Future stops per trip in the earliest snapshot (smallest clock).

    Rows of the earliest ``currentTime`` are exactly the rows of rank 1 in
    ``rank() over (order by currentTime)``. The minimum is a global
    aggregate of one value per task, joined back as a broadcast of one row;
    the ranked form would move the whole board into one partition. On a
    board table this reads the clock column twice and shuffles only the first
    snapshot's rows. On a live plan the board would be computed for each
    branch: pass ``clocks``, any frame with the same set of ``currentTime``
    that costs less (``board_keys``)."""
    first = (board if clocks is None else clocks).agg(F.min("currentTime").alias("_first"))
    rows = board.join(F.broadcast(first), F.col("currentTime") == F.col("_first"))
    return _q9_sum(rows.drop("_first"))


def rank_by_clock(board: DataFrame) -> DataFrame:
    """Every board row's rank by clock over the whole board, ties alike: the
    ranked form of the first-snapshot question before its filter. For a board
    *table* (read twice)."""
    return global_rank(board.select("tripId", "routeId", "currentTime", "numOfFutureStops"), "currentTime")


def q9_ranked(board: DataFrame) -> DataFrame:
    """Q9 as the original asks it, by the rank itself."""
    return _q9_sum(rank_by_clock(board).where(F.col("rnk") == 1))


def q9_first_snapshot_pruned(board: DataFrame) -> DataFrame:
    """Q9 for a board *table*: the minimum clock is computed first (one value
    reaches the driver) and then applied as a literal, so the equality filter
    reaches the Parquet scan and row-group statistics skip every file without
    the first snapshot (the append sink writes files per micro-batch, each
    with a narrow clock range). The minimum is taken when this is called."""
    first = board.agg(F.min("currentTime")).first()[0]
    if first is None:
        return _q9_sum(board.where(F.lit(False)))
    # text literal: a Python datetime literal would be read in the session zone
    first_ntz = F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")
    return _q9_sum(board.where(F.col("currentTime") == first_ntz))


QUERIES = {
    "q1_all": q1_all,
    "q2_count": q2_count,
    "q3_first_rows": q3_first_rows,
    "q4_trips_per_route": q4_trips_per_route,
    "q5_started_between": q5_started_between,
    "q6_current_and_next": q6_current_and_next,
    "q7_minutes_to_next": q7_minutes_to_next,
    "q7_minutes_boundary": q7_minutes_boundary,
    "q8_last_stop": q8_last_stop,
    "q9_first_snapshot": q9_first_snapshot,
}
