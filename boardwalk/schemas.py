"""Fixed schemas of the feed messages and of the trip board.

Messages are parsed with declared schemas, never inferred: a schema change in
the feed must be a code change, and inference would need a pass over the data.
"""

from pyspark.sql import types as T

# The field names and types of the feed messages below are the
# feed's wire format, and the four trip fields are the join key of the board.
TRIP_KEYS = ["tripId", "routeId", "startTime", "startDate"]

TRIP = T.StructType(
    [
        T.StructField("tripId", T.StringType()),
        T.StructField("startTime", T.StringType()),
        T.StructField("startDate", T.StringType()),
        T.StructField("routeId", T.StringType()),
    ]
)

_EVENT_TIME = T.StructType([T.StructField("time", T.StringType())])

STOP_TIME_UPDATE = T.StructType(
    [
        T.StructField("arrival", _EVENT_TIME),
        T.StructField("stopId", T.StringType()),
        T.StructField("departure", _EVENT_TIME),
    ]
)

# A trip update: the trip and its remaining stops in order.
TRIP_UPDATE = T.StructType(
    [
        T.StructField("trip", TRIP),
        T.StructField("stopTimeUpdate", T.ArrayType(STOP_TIME_UPDATE)),
    ]
)

# The parts of messages that the board reads, and their trip alone.
BOARD_UPDATE = T.StructType(
    [
        T.StructField("trip", TRIP),
        T.StructField("stopTimeUpdate", T.ArrayType(T.StructType([STOP_TIME_UPDATE["arrival"], STOP_TIME_UPDATE["stopId"]]))),
    ]
)
TRIP_ONLY = T.StructType([T.StructField("trip", TRIP)])

# A trip status (vehicle position): where the vehicle is on its trip.
TRIP_STATUS = T.StructType(
    [
        T.StructField("trip", TRIP),
        T.StructField("currentStopSequence", T.IntegerType()),
        T.StructField("currentStatus", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("stopId", T.StringType()),
    ]
)

# One polled feed document holding many entities; an entity may carry a trip
# update, a vehicle status, or both.
FEED_ENTITY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tripUpdate", TRIP_UPDATE),
        T.StructField("vehicle", TRIP_STATUS),
    ]
)
FEED_SNAPSHOT = T.StructType([T.StructField("entity", T.ArrayType(FEED_ENTITY))])

# A stored feed snapshot: the poll's document text and when it was polled.
SNAPSHOT_FILE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# Normalised message envelope for every source (Kafka, Kinesis, files).
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# The trip board's column names, in output order.
BOARD_COLUMNS = [
    "tripId",
    "routeId",
    "startTime",
    "numOfFutureStops",
    "currentStopSequence",
    "currentStatus",
    "currentStopId",
    "nextStopArrivalTime",
    "nextStopId",
    "lastStopArrivalTime",
    "lastStopId",
    "currentTime",
]

BOARD = T.StructType(
    [
        T.StructField("tripId", T.StringType()),
        T.StructField("routeId", T.StringType()),
        T.StructField("startTime", T.TimestampNTZType()),
        T.StructField("numOfFutureStops", T.IntegerType()),
        T.StructField("currentStopSequence", T.IntegerType()),
        T.StructField("currentStatus", T.StringType()),
        T.StructField("currentStopId", T.StringType()),
        T.StructField("nextStopArrivalTime", T.TimestampNTZType()),
        T.StructField("nextStopId", T.StringType()),
        T.StructField("lastStopArrivalTime", T.TimestampNTZType()),
        T.StructField("lastStopId", T.StringType()),
        T.StructField("currentTime", T.TimestampNTZType()),
    ]
)

# Columns carried next to the board so that "latest row per trip" has a total
# order. Split by side so the order can be evaluated before the join.
UPDATE_ORDER = ["u_ingest_ts", "u_hash"]
STATUS_ORDER = ["s_event_ts", "s_ingest_ts", "s_hash"]
LATEST_ORDER = ["currentTime", "s_event_ts", "u_ingest_ts", "s_ingest_ts", "u_hash", "s_hash"]

_ORDER_TYPES = {
    "s_event_ts": T.TimestampNTZType(),
    "u_ingest_ts": T.TimestampType(),
    "s_ingest_ts": T.TimestampType(),
    "u_hash": T.LongType(),
    "s_hash": T.LongType(),
}
BOARD_WITH_ORDER = T.StructType([*BOARD, *[T.StructField(c, _ORDER_TYPES[c]) for c in LATEST_ORDER if c not in BOARD_COLUMNS]])
