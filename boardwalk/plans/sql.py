"""The nine questions as Spark SQL text over a board view, for users who
ask them in SQL (``register_board`` / ``register_board_path`` first).

Same results as the DataFrame forms in ``adhoc.py`` (tested). Board times are
whole seconds in UTC wall time, so minutes come from ``unix_timestamp``, which
reads ``timestamp_ntz`` without the session zone: ``div`` of the difference
gives elapsed minutes, a difference of floored minutes gives boundaries. Q9
keeps the earliest clock with a scalar subquery instead of a global rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boardwalk.plans.adhoc import Q5_FROM, Q5_TO
from boardwalk.schemas import BOARD_COLUMNS

_Q3 = BOARD_COLUMNS[:-1]
_Q3_COLS = ", ".join(_Q3)
_Q3_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in _Q3)

SQL = {
    "q1_all": "SELECT * FROM {board}",
    "q2_count": "SELECT count(tripId) AS numOfTrips FROM {board}",
    "q3_first_rows": f"SELECT {_Q3_COLS} FROM {{board}} ORDER BY {_Q3_ORDER} LIMIT 10",
    "q4_trips_per_route": "SELECT routeId, count(tripId) AS numOfTrips FROM {board} GROUP BY routeId ORDER BY routeId NULLS LAST",
    "q5_started_between": (
        "SELECT count(tripId) AS numOfTrips, routeId FROM {board} "
        "WHERE startTime BETWEEN TIMESTAMP_NTZ '{lo}' AND TIMESTAMP_NTZ '{hi}' "
        "GROUP BY routeId, startTime ORDER BY 1 DESC"
    ),
    "q6_current_and_next": (
        "SELECT tripId, routeId, currentStopSequence, currentStatus, currentStopId, nextStopId FROM {board}"
    ),
    "q7_minutes_to_next": (
        "SELECT tripId, routeId, minutesRemainingUntilNextStop FROM ("
        " SELECT tripId, routeId,"
        " (unix_timestamp(nextStopArrivalTime) - unix_timestamp(currentTime)) div 60 AS minutesRemainingUntilNextStop"
        " FROM {board}) t WHERE minutesRemainingUntilNextStop >= 0"
    ),
    "q7_minutes_boundary": (
        "SELECT tripId, routeId, minutesRemainingUntilNextStop FROM ("
        " SELECT tripId, routeId,"
        " floor(unix_timestamp(nextStopArrivalTime) / 60) - floor(unix_timestamp(currentTime) / 60)"
        " AS minutesRemainingUntilNextStop FROM {board}) t WHERE minutesRemainingUntilNextStop >= 0"
    ),
    "q8_last_stop": "SELECT tripId, routeId, lastStopId, lastStopArrivalTime FROM {board}",
    "q9_first_snapshot": (
        "SELECT tripId, routeId, currentTime, sum(numOfFutureStops) AS numOfFutureStops FROM {board} "
        "WHERE currentTime = (SELECT min(currentTime) FROM {board}) GROUP BY 1, 2, 3 ORDER BY 4 DESC"
    ),
}

# Of a board laid out by start (``layout.py``), with its ``startPart``.
CLUSTERED_SQL = {
    "q5_clustered": (
        "SELECT count(tripId) AS numOfTrips, routeId FROM {board} "
        "WHERE startPart BETWEEN trunc(DATE '{lo_day}', '{unit}') AND trunc(DATE '{hi_day}', '{unit}') "
        "AND startTime BETWEEN TIMESTAMP_NTZ '{lo}' AND TIMESTAMP_NTZ '{hi}' "
        "GROUP BY routeId, startTime ORDER BY 1 DESC"
    ),
    "lookup_by_trip": "SELECT {columns} FROM {board} WHERE tripId IN ({ids})",
}


def sql_text(name: str, board: str = "board", lo: str = Q5_FROM, hi: str = Q5_TO) -> str:
    return SQL[name].format(board=board, lo=lo, hi=hi)


def run_sql(spark: SparkSession, name: str, board: str = "board", **params) -> DataFrame:
    return spark.sql(sql_text(name, board, **params))
