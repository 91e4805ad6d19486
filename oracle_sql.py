"""Independent DuckDB SQL for every registered query.

The board is computed here straight from the base tables (orders,
lineitem), not from the JSON messages the Spark side parses, so the two paths
share nothing but the fixture rules (``boardwalk/sources/fixtures.py``).
"""

from __future__ import annotations

LA = "America/Los_Angeles"
NY = "America/New_York"


def _shift(expr: str, tz: str = LA) -> str:
    """Wall time read as local to ``tz``, as UTC wall time."""
    return f"timezone('UTC', timezone('{tz}', {expr}))"


# Per order: the message fields and its first and last stop.
_TRIPS = """
o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         CASE WHEN o_orderkey % 22 + 3 = 24 THEN 25 ELSE o_orderkey % 22 + 3 END AS hh
  FROM orders
),
l AS (
  SELECT l_orderkey,
         count(*) AS n,
         arg_min(l_partkey, (l_linenumber, l_shipdate, l_partkey)) AS first_part,
         arg_min(l_shipdate, (l_linenumber, l_shipdate, l_partkey)) AS first_ship,
         arg_max(l_partkey, (l_linenumber, l_shipdate, l_partkey)) AS last_part,
         arg_max(l_shipdate, (l_linenumber, l_shipdate, l_partkey)) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
polls AS (SELECT * FROM (VALUES (0), (1)) p(poll)),
u AS (
  SELECT o.*, l.*, poll, o_orderdate + to_minutes(poll) AS u_ingest,
         CASE WHEN k % 7 = 0 THEN NULL ELSE first_ship END AS next_ship,
         CASE WHEN k % 7 = 0 AND n = 1 THEN NULL ELSE last_ship END AS last_ship2
  FROM o LEFT JOIN l ON o.k = l.l_orderkey
  JOIN polls ON poll = 0 OR k % 11 = 0
),
ub AS (
  SELECT u.*,
         CASE WHEN hh = 24 OR hh = 25 THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(hh) + to_minutes(k % 60) END AS start_local
  FROM u WHERE k % 13 <> 0
)
"""


def _board(mode: str = "reference") -> str:
    if mode == "reference":
        start, nxt, lst, now = (
            _shift("start_local"),
            _shift("next_ship"),
            _shift("last_ship2"),
            _shift("u_ingest"),
        )
    else:
        start, nxt, lst, now = _shift("start_local", NY), "next_ship", "last_ship2", "u_ingest"
    return f"""
WITH {_TRIPS},
board AS (
  SELECT CAST(k AS VARCHAR) AS tripId,
         replace(o_orderpriority, ' ', '') AS routeId,
         {start} AS startTime,
         CAST(coalesce(n, 0) AS INTEGER) AS numOfFutureStops,
         CAST(k % 20 AS INTEGER) AS currentStopSequence,
         CASE WHEN o_orderstatus = 'F' THEN 'STOPPED_AT' ELSE 'ON_THE_ROAD' END AS currentStatus,
         CAST(o_custkey AS VARCHAR) AS currentStopId,
         {nxt} AS nextStopArrivalTime,
         CAST(first_part AS VARCHAR) AS nextStopId,
         {lst} AS lastStopArrivalTime,
         CAST(last_part AS VARCHAR) AS lastStopId,
         {now} AS currentTime
  FROM ub
)"""


BOARD = _board()
BOARD_COLS = (
    "tripId, routeId, startTime, numOfFutureStops, currentStopSequence, currentStatus, "
    "currentStopId, nextStopArrivalTime, nextStopId, lastStopArrivalTime, lastStopId, currentTime"
)
_Q3_COLS = [
    "tripId", "routeId", "startTime", "numOfFutureStops", "currentStopSequence", "currentStatus",
    "currentStopId", "nextStopArrivalTime", "nextStopId", "lastStopArrivalTime", "lastStopId",
]

_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
_START_TEXT = "printf('%02d:%02d:00', hh, k % 60)"


def _q5(lo: str, hi: str) -> str:
    return f"""{BOARD}
SELECT count(tripId) AS numOfTrips, routeId FROM board
WHERE startTime BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}'
GROUP BY routeId, startTime ORDER BY 1 DESC"""


def _q7(fn: str) -> str:
    return f"""{BOARD}
SELECT tripId, routeId, minutesRemainingUntilNextStop FROM (
  SELECT tripId, routeId, {fn}('minute', currentTime, nextStopArrivalTime) AS minutesRemainingUntilNextStop
  FROM board) t
WHERE minutesRemainingUntilNextStop >= 0"""


_UPDATES = f"""
SELECT CAST(k AS VARCHAR) AS tripId, replace(o_orderpriority, ' ', '') AS routeId,
       {_START_TEXT} AS startTime, strftime(o_orderdate, '%Y%m%d') AS startDate"""

_STATUS_RAW = f"""WITH {_TRIPS}
SELECT CAST(k AS VARCHAR) AS tripId, replace(o_orderpriority, ' ', '') AS routeId,
       {_START_TEXT} AS startTime, strftime(o_orderdate, '%Y%m%d') AS startDate,
       CAST(k % 20 AS INTEGER) AS currentStopSequence,
       CASE o_orderstatus WHEN 'F' THEN 'STOPPED_AT' WHEN 'O' THEN 'IN_TRANSIT_TO' END AS currentStatus,
       CAST(o_custkey AS VARCHAR) AS stopId,
       CAST(date_diff('second', {_EPOCH}, o_orderdate) AS VARCHAR) AS timestamp,
       o_orderdate AS s_ingest_ts
FROM o WHERE k % 13 <> 0"""


def _epoch_text(c: str) -> str:
    return f"CAST(date_diff('second', {_EPOCH}, {c}) AS VARCHAR)"


_FEED_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'STOPPED_AT' WHEN 'O' THEN 'IN_TRANSIT_TO' END"
# An order's stops in message order, as comma-joined text ('-' for a time left out).
_BY = "ORDER BY l_linenumber, l_shipdate, l_partkey"
_STOP_TEXT = f"""
ln AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey {_BY}) AS i FROM lineitem),
st AS (
  SELECT l_orderkey AS okey,
         string_agg(CAST(l_partkey AS VARCHAR), ',' {_BY}) AS stopIds,
         string_agg(CASE WHEN i = 1 AND l_orderkey % 7 = 0 THEN '-' ELSE {_epoch_text('l_shipdate')} END, ',' {_BY}) AS arrivals,
         string_agg(CAST(date_diff('second', {_EPOCH}, l_shipdate) + 60 AS VARCHAR), ',' {_BY}) AS departures
  FROM ln GROUP BY l_orderkey
)
"""


def queries() -> dict[str, str]:
    q = _live()
    # The same questions asked in SQL of a stored board.
    q |= {f"sql_{name}": q[name] for name in list(q) if name[0] == "q" and name[1].isdigit()}
    q |= {"sql_q9_pruned": q["q9_first_snapshot"], "q9_ranked": q["q9_first_snapshot"], "rollup_first_snapshot": q["q9_first_snapshot"]}
    return q | {"sql_q5_clustered": q["q5_started_between_1998"]}


def _live() -> dict[str, str]:
    q3_order = ", ".join(f"{c} ASC NULLS FIRST" for c in _Q3_COLS)
    q3_cols = ", ".join(_Q3_COLS)
    latest = f"""{BOARD}
SELECT {BOARD_COLS} FROM board
QUALIFY row_number() OVER (PARTITION BY tripId ORDER BY currentTime DESC) = 1"""
    by_route_topic = f"""WITH {_TRIPS}, {_STOP_TEXT}
SELECT topic, routeId, count(*) AS messages, CAST(sum(chars) AS BIGINT) AS stopIdChars, count(status) AS statuses, max(ts) AS lastTimestamp FROM (
  SELECT 'trip_updates' AS topic, replace(o_orderpriority, ' ', '') AS routeId, length(stopIds) AS chars, NULL AS status, NULL AS ts
  FROM u LEFT JOIN st ON k = st.okey
  UNION ALL
  SELECT 'trip_status', replace(o_orderpriority, ' ', ''), NULL, {_FEED_STATUS}, {_epoch_text('o_orderdate')}
  FROM u WHERE poll = 0 AND k % 13 <> 0
) m GROUP BY topic, routeId"""
    return {
        "trip_board": f"{BOARD}\nSELECT * FROM board",
        "trip_board_instant": f"{_board('instant')}\nSELECT * FROM board",
        "q1_all": f"{BOARD}\nSELECT {BOARD_COLS} FROM board",
        "q2_count": f"{BOARD}\nSELECT count(tripId) AS numOfTrips FROM board",
        "q3_first_rows": f"{BOARD}\nSELECT {q3_cols} FROM board ORDER BY {q3_order} LIMIT 10",
        "q4_trips_per_route": f"""{BOARD}
SELECT routeId, count(tripId) AS numOfTrips FROM board GROUP BY routeId ORDER BY routeId""",
        "q5_started_between": _q5("2022-10-12 00:00:00", "2022-10-18 18:00:00"),
        "q5_started_between_1998": _q5("1998-01-01 00:00:00", "1998-06-30 18:00:00"),
        "q6_current_and_next": f"""{BOARD}
SELECT tripId, routeId, currentStopSequence, currentStatus, currentStopId, nextStopId FROM board""",
        "q7_minutes_to_next": _q7("date_sub"),
        "q7_minutes_boundary": _q7("date_diff"),
        "q8_last_stop": f"{BOARD}\nSELECT tripId, routeId, lastStopId, lastStopArrivalTime FROM board",
        "q9_first_snapshot": f"""{BOARD}
SELECT tripId, routeId, currentTime, CAST(sum(numOfFutureStops) AS BIGINT) AS numOfFutureStops FROM
(SELECT tripId, routeId, currentTime, numOfFutureStops, rank() OVER (ORDER BY currentTime) AS rnk FROM board) t
WHERE rnk = 1 GROUP BY 1, 2, 3 ORDER BY 4 DESC""",
        "latest_per_trip": latest,
        "updates_parsed": f"""WITH {_TRIPS}{_UPDATES},
       CAST(coalesce(n, 0) AS INTEGER) AS numStops, u_ingest AS u_ingest_ts
FROM u""",
        "status_parsed": _STATUS_RAW,
        "stops_reshaped": f"""WITH {_TRIPS}{_UPDATES},
       CAST(coalesce(n, 0) AS INTEGER) AS numOfFutureStops,
       {_epoch_text('next_ship')} AS nextArrival, CAST(first_part AS VARCHAR) AS nextStopId,
       {_epoch_text('last_ship2')} AS lastArrival, CAST(last_part AS VARCHAR) AS lastStopId,
       u_ingest AS u_ingest_ts
FROM u""",
        "status_normalised": f"""WITH {_TRIPS}
SELECT CAST(k AS VARCHAR) AS tripId,
       CASE WHEN o_orderstatus = 'F' THEN 'STOPPED_AT' ELSE 'ON_THE_ROAD' END AS currentStatus,
       CAST(o_custkey AS VARCHAR) AS currentStopId, CAST(k % 20 AS INTEGER) AS currentStopSequence,
       o_orderdate AS s_event_ts
FROM o WHERE k % 13 <> 0""",
        "trip_join": f"""WITH {_TRIPS}{_UPDATES},
       CAST(coalesce(n, 0) AS INTEGER) AS numOfFutureStops, CAST(first_part AS VARCHAR) AS nextStopId,
       CAST(k % 20 AS INTEGER) AS currentStopSequence,
       CASE WHEN o_orderstatus = 'F' THEN 'STOPPED_AT' ELSE 'ON_THE_ROAD' END AS currentStatus,
       u_ingest AS u_ingest_ts, o_orderdate AS s_ingest_ts
FROM ub""",
        "feed_split": f"""WITH {_TRIPS}, {_STOP_TEXT}
SELECT 'trip_updates' AS topic, CAST(k AS VARCHAR) AS tripId, replace(o_orderpriority, ' ', '') AS routeId,
       {_START_TEXT} AS startTime, strftime(o_orderdate, '%Y%m%d') AS startDate,
       stopIds, arrivals, departures,
       NULL AS currentStatus, NULL AS timestamp, u_ingest AS ingest_ts
FROM u LEFT JOIN st ON k = st.okey
UNION ALL
SELECT 'trip_status', CAST(k AS VARCHAR), replace(o_orderpriority, ' ', ''),
       {_START_TEXT}, strftime(o_orderdate, '%Y%m%d'), NULL, NULL, NULL, {_FEED_STATUS}, {_epoch_text('o_orderdate')}, u_ingest
FROM u WHERE poll = 0 AND k % 13 <> 0""",
        "feed_compact": by_route_topic,
        "feed_union": by_route_topic,
        "board_from_feed": f"{BOARD}\nSELECT * FROM board",
        "board_default_clock": f"""{BOARD}
SELECT routeId, count(tripId) AS numOfTrips, CAST(sum(numOfFutureStops) AS BIGINT) AS numOfFutureStops, 1 AS clocks
FROM board GROUP BY routeId""",
        "stream_late_dropped": f"""{BOARD}
SELECT {BOARD_COLS} FROM board WHERE NOT (CAST(tripId AS BIGINT) % 17 = 5 AND
  (SELECT o_orderdate FROM orders WHERE o_orderkey = CAST(tripId AS BIGINT)) < TIMESTAMP '1998-01-01')""",
        "stream_upsert_replayed": latest,
        "stream_append": f"{BOARD}\nSELECT {BOARD_COLS} FROM board",
        "stream_join_bounded": f"{BOARD}\nSELECT {BOARD_COLS} FROM board",
        "stream_upsert": latest,
        "stream_upsert_compacted": latest,
        "stream_latest_changes": latest,
        "stream_state_rows": f"""WITH {_TRIPS}
SELECT 'updates' AS side, count(*) AS rows FROM u HAVING count(*) > 0
UNION ALL
SELECT 'status', count(*) FROM o WHERE k % 13 <> 0 HAVING count(*) > 0""",
        "stream_from_latest": f"{BOARD}\nSELECT {BOARD_COLS} FROM board WHERE CAST(tripId AS BIGINT) % 3 = 1",
        "rank_by_clock": f"""{BOARD}
SELECT tripId, routeId, currentTime, rank() OVER (ORDER BY currentTime) AS rnk FROM board""",
        "board_bucketed": f"{BOARD}\nSELECT {BOARD_COLS} FROM board",
        "rollup_trips_per_route": f"""{BOARD}
SELECT routeId, count(tripId) AS numOfTrips FROM board GROUP BY routeId ORDER BY routeId""",
        "dead_letters": f"""WITH {_TRIPS}
SELECT 'updates' AS kind, CAST(k AS VARCHAR) AS key, u_ingest AS ingest_ts FROM u WHERE k % 17 = 3
UNION ALL
SELECT 'status', CAST(k AS VARCHAR), o_orderdate FROM o WHERE k % 17 = 3 AND k % 13 <> 0""",
        "board_after_intake": f"{BOARD}\nSELECT {BOARD_COLS} FROM board WHERE CAST(tripId AS BIGINT) % 17 <> 3",
        "sql_lookup_by_trip": f"""{BOARD}
SELECT {BOARD_COLS} FROM board WHERE tripId IN (SELECT CAST(o_orderkey AS VARCHAR) FROM (SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 5) f)""",
    }
