"""Every query the engine registers: ``(spark, sf_dir) -> DataFrame``.

All read the driver's tables (orders, lineitem) in full and derive the feed
from them; nothing runs on made-up input. Streaming entries replay that feed
through a real stream (file source, stateful join, sink) and return the
sink's table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.functions import instant_to_utc, stop_count
from boardwalk.functions.timefn import INSTANT
from boardwalk.operators import derive_board, join_feeds, reshape_status, reshape_updates, split_feed, topic, union_feeds
from boardwalk.plans import adhoc
from boardwalk.plans.board_plan import FIXTURE_CLOCK, board_from_messages, board_keys, feeds, key_messages, latest_trip_board, messages, table, trip_board
from boardwalk.plans.sql import CLUSTERED_SQL, SQL, run_sql
from boardwalk.session import file_times, list_dir, settled, working_folder
from boardwalk.sources import feed_snapshots, parse_status, parse_updates, read_board, register_board_path
from boardwalk.sources.bucketed import join_bucketed, store_bucketed
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC
from boardwalk.sources.layout import CLUSTERED, write_clustered
from boardwalk.streaming import (
    AVAILABLE_NOW,
    FeedReplay,
    append_latest,
    append_rollup,
    board_stream,
    compact,
    fold_rollup,
    kept_heavy_trips,
    read_dead_letters,
    read_latest,
    read_parsed,
    rollup,
    state_by_partition,
    write_append,
    write_intake,
    write_latest,
    write_rollup,
    write_upsert,
)

Query = Callable[[SparkSession, str], DataFrame]

# A window inside the fixture data's years for the "started between" question
# (the original's own window, October 2022, is registered as well).
Q5_FIXTURE_WINDOW = ("1998-01-01 00:00:00", "1998-06-30 18:00:00")

#: The fields of either message kind.
_EITHER = T.StructType([*schemas.TRIP_UPDATE, *[f for f in schemas.TRIP_STATUS if f.name != "trip"]])


def _adhoc(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(trip_board(spark, sf_dir))


def _message_fields(msgs: DataFrame) -> DataFrame:
    """Topic, trip identity and payload of routed messages, parsed in one pass
    with both kinds' fields; lists as text, so that they compare whole."""
    m = F.from_json("value", _EITHER)
    stops = m["stopTimeUpdate"]
    listed = lambda f: F.array_join(F.transform(stops, f), ",", "-")
    return msgs.select(
        "topic",
        m["trip"]["tripId"].alias("tripId"),
        m["trip"]["routeId"].alias("routeId"),
        m["trip"]["startTime"].alias("startTime"),
        m["trip"]["startDate"].alias("startDate"),
        listed(lambda x: x["stopId"]).alias("stopIds"),
        listed(lambda x: x["arrival"]["time"]).alias("arrivals"),
        listed(lambda x: x["departure"]["time"]).alias("departures"),
        m["currentStatus"].alias("currentStatus"),
        m["timestamp"].alias("timestamp"),
        instant_to_utc("ingest_ts").alias("ingest_ts"),
    )


def _per_route(msgs: DataFrame) -> DataFrame:
    return _message_fields(msgs).groupBy("topic", "routeId").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.when(F.col("stopIds") != "", F.length("stopIds"))).alias("stopIdChars"),
        F.count("currentStatus").alias("statuses"),
        F.max("timestamp").alias("lastTimestamp"),
    )


def updates_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_updates(topic(messages(spark, sf_dir), UPDATES_TOPIC))
    return p.select(
        "tripId", "routeId", "startTime", "startDate",
        stop_count("stopTimeUpdate").alias("numStops"),
        instant_to_utc("u_ingest_ts").alias("u_ingest_ts"),
    )


def status_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_status(topic(messages(spark, sf_dir), STATUS_TOPIC))
    return p.select(
        "tripId", "routeId", "startTime", "startDate", "currentStopSequence", "currentStatus", "stopId",
        "timestamp", instant_to_utc("s_ingest_ts").alias("s_ingest_ts"),
    )


def stops_reshaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = reshape_updates(parse_updates(topic(messages(spark, sf_dir), UPDATES_TOPIC)))
    return u.drop("u_hash").withColumn("u_ingest_ts", instant_to_utc("u_ingest_ts"))


def status_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = reshape_status(parse_status(topic(messages(spark, sf_dir), STATUS_TOPIC)))
    return s.select("tripId", "currentStatus", "currentStopId", "currentStopSequence", "s_event_ts")


def trip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, s = feeds(messages(spark, sf_dir))
    j = join_feeds(u, s)
    return j.select(
        "tripId", "routeId", "startTime", "startDate", "numOfFutureStops", "nextStopId",
        "currentStopSequence", "currentStatus",
        instant_to_utc("u_ingest_ts").alias("u_ingest_ts"), instant_to_utc("s_ingest_ts").alias("s_ingest_ts"),
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_snapshots(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def feed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _message_fields(split_feed(_snapshots(spark, sf_dir)))


def feed_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_route(messages(spark, sf_dir))


def _feeds_apart(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The route-group feeds as the separate inputs that they are: snapshots
    written once by feed, each feed's folder read on its own."""
    folder = working_folder(spark, "feeds")
    _snapshots(spark, sf_dir).write.partitionBy("feed").parquet(folder)
    return [spark.read.schema(schemas.SNAPSHOT_FILE).parquet(f"{folder}/{name}") for name in list_dir(spark, folder) if name.startswith("feed=")]


def _union_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_feed = _feeds_apart(spark, sf_dir)
    return split_feed(union_feeds(*per_feed) if per_feed else _snapshots(spark, sf_dir))


def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route-group feeds, each its own input, merged and split."""
    return _per_route(_union_split(spark, sf_dir))


def board_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board from the polled documents on: feeds merged, split into
    messages, parsed, joined, derived."""
    return board_from_messages(_union_split(spark, sf_dir))


def board_default_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board stamped with the query's own time, by route: all rows of a
    batch carry one time, whatever it is."""
    board = board_from_messages(messages(spark, sf_dir), clock=None)
    return board.groupBy("routeId").agg(
        F.count("tripId").alias("numOfTrips"),
        F.sum("numOfFutureStops").alias("numOfFutureStops"),
        F.count_distinct("currentTime").alias("clocks"),
    )


def q2_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.q2_count(board_keys(key_messages(spark, sf_dir)))


def q4_trips_per_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.q4_trips_per_route(board_keys(key_messages(spark, sf_dir)))


def q9_first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.q9_first_snapshot(trip_board(spark, sf_dir), board_keys(key_messages(spark, sf_dir)))


# -- a stored board, asked in SQL ---------------------------------------------------
_stored: dict[tuple, str] = {}


def _kept(kind: str, spark: SparkSession, sf_dir: str, make: Callable[[str, str], None]) -> str:
    """The name of something stored from the tables of ``sf_dir``, made by
    ``make(name, path)`` once per application and state of those files."""
    files = [tuple(sorted(file_times(spark, f"{sf_dir}/{t}.parquet").items())) for t in ("orders", "lineitem")]
    at = (spark.sparkContext.applicationId, kind, sf_dir, *files)
    if at not in _stored or not spark.catalog.tableExists(_stored[at]):
        name = f"boardwalk_{kind}_{uuid.uuid4().hex}"
        make(name, working_folder(spark, kind))
        _stored[at] = name
    return _stored[at]


def stored_board(spark: SparkSession, sf_dir: str) -> str:
    """The name of a catalog view over the board of ``sf_dir`` as files."""

    def make(name: str, path: str) -> None:
        trip_board(spark, sf_dir).write.parquet(path)
        register_board_path(spark, path, name)

    return _kept("board", spark, sf_dir, make)


#: The layout unit of the registered clustered board: its starts span years.
CLUSTER_UNIT = "month"


def clustered_board(spark: SparkSession, sf_dir: str) -> str:
    """The name of a catalog view over the board laid out by start."""

    def make(name: str, path: str) -> None:
        write_clustered(spark.table(stored_board(spark, sf_dir)), path, CLUSTER_UNIT)
        register_board_path(spark, path, name, CLUSTERED.names)

    return _kept("clustered", spark, sf_dir, make)


def _sql(name: str, spark: SparkSession, sf_dir: str, **params) -> DataFrame:
    return run_sql(spark, name, stored_board(spark, sf_dir), **params)


def sql_q9_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot's clock found first, then pushed to the scan."""
    return adhoc.q9_first_snapshot_pruned(spark.table(stored_board(spark, sf_dir)))


def sql_q5_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 from the folders of its interval."""
    lo, hi = Q5_FIXTURE_WINDOW
    text = CLUSTERED_SQL["q5_clustered"]
    return spark.sql(text.format(board=clustered_board(spark, sf_dir), lo=lo, hi=hi, lo_day=lo[:10], hi_day=hi[:10], unit=CLUSTER_UNIT))


def sql_lookup_by_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the trips with the five smallest order keys."""
    first = table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey").limit(5).collect()
    ids = ", ".join(f"'{r[0]}'" for r in first) or "NULL"
    return spark.sql(CLUSTERED_SQL["lookup_by_trip"].format(board=clustered_board(spark, sf_dir), columns=", ".join(schemas.BOARD_COLUMNS), ids=ids))


def rank_by_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = adhoc.rank_by_clock(spark.table(stored_board(spark, sf_dir)))
    return ranked.select("tripId", "routeId", "currentTime", "rnk")


def q9_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.q9_ranked(spark.table(stored_board(spark, sf_dir)))


def board_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board from both feeds stored bucketed by trip: no exchange."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def make(side: int, name: str, path: str) -> None:
        store_bucketed(feeds(messages(spark, sf_dir))[side], name, path, n)

    names = [_kept(f"{kind}_{n}", spark, sf_dir, partial(make, i)) for i, kind in enumerate(("updates", "status"))]
    return derive_board(join_bucketed(spark, *names), clock=FIXTURE_CLOCK)


def trip_board_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_board(spark, sf_dir, mode=INSTANT)


def latest_per_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_trip_board(spark, sf_dir)


# -- streams ---------------------------------------------------------------------
def _trip_slices(msgs: DataFrame) -> Column:
    """Three slices; a trip's status lands one slice after its updates, so the
    join must hold state across micro-batches (and query restarts)."""
    k = F.col("key").cast("bigint")
    return F.when(F.col("topic") == UPDATES_TOPIC, F.pmod(k, F.lit(3))).otherwise(F.pmod(k + 1, F.lit(3)))


def _time_slices(msgs: DataFrame) -> Column:
    """Ingest months; delivered in three groups of consecutive months, so the
    feed arrives in time order, as a live feed does."""
    return F.date_format(instant_to_utc("ingest_ts"), "yyyyMM").cast("int")


def _staged(spark: SparkSession, sf_dir: str, name: str, slices, state_partitions: int | None = None, change=None) -> FeedReplay:
    """A replay whose feed is staged, and whose heavy trips are known: what a
    broker holds of the updates when the stream is first started."""
    msgs = messages(spark, sf_dir)
    msgs = change(msgs) if change else msgs
    r = FeedReplay(spark, name, state_partitions=state_partitions)
    r.stage(msgs, slices(msgs))
    kept_heavy_trips(r.staged(UPDATES_TOPIC), r.path("ckpt"))
    return r


def _replay(spark: SparkSession, sf_dir: str, name: str, slices, start, groups=None, state_partitions: int | None = None, then=None) -> FeedReplay:
    """Stage the feed, then deliver its slices group by group (conditions over
    ``slice``; by default the first three slices one by one), draining each
    with a restart of the stream. ``then`` sees the replay before its inputs
    and checkpoint go."""
    r = _staged(spark, sf_dir, name, slices, state_partitions)
    for wanted in groups or [f"slice = {i}" for i in range(3)]:
        r.deliver(wanted)
        start(r).awaitTermination()
    if then:
        then(r)
    r.release_inputs()
    return r


#: The share of all updates that the hottest trip is expected to have at most.
HOT_SHARE = 1 / 3


def _salt(r: FeedReplay) -> int:
    """Parts that a heavy trip's updates are dealt into in the streams' join,
    two at least, so that the hottest trip has a state partition's share in
    each. The same in every restart, as the number of state partitions is."""
    return max(2, math.ceil(HOT_SHARE * int(r.stream_spark.conf.get("spark.sql.shuffle.partitions"))))


def _board_stream(r: FeedReplay, **how) -> DataFrame:
    heavy = kept_heavy_trips(r.staged(UPDATES_TOPIC), r.path("ckpt"))
    return board_stream(r.envelopes(UPDATES_TOPIC), r.envelopes(STATUS_TOPIC), clock=FIXTURE_CLOCK, salt=_salt(r), heavy=heavy, **how)


def _appended(r: FeedReplay, **how):
    return write_append(_board_stream(r, **how), r.path("board"), r.path("ckpt"), trigger=AVAILABLE_NOW)


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replay(spark, sf_dir, "stream_append", _trip_slices, _appended)
    return read_board(spark, r.path("board"), missing_ok=True)


# Bounds of the months that arrive together, in time order.
_MONTHS = ["slice < 199405", "slice BETWEEN 199405 AND 199604", "slice >= 199605"]


def stream_join_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replay(spark, sf_dir, "stream_join_bounded", _time_slices, partial(_appended, bound="1 hour"), _MONTHS)
    return read_board(spark, r.path("board"), missing_ok=True)


def _late_slices(msgs: DataFrame) -> Column:
    """Everything first; after it the statuses of every 17th trip that began
    before 1998, by then years behind the watermark."""
    late = (F.col("topic") == STATUS_TOPIC) & (F.pmod(F.col("key").cast("bigint"), F.lit(17)) == 5)
    return F.when(late & (instant_to_utc("ingest_ts") < F.lit("1998-01-01").cast("timestamp_ntz")), F.lit(1)).otherwise(F.lit(0))


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded join drops rows behind its watermark."""
    groups = [f"slice = {i}" for i in range(2)]
    r = _replay(spark, sf_dir, "stream_late_dropped", _late_slices, partial(_appended, bound="1 hour"), groups)
    return read_board(spark, r.path("board"), missing_ok=True)


def _upserted(r: FeedReplay, **how):
    return write_upsert(_board_stream(r, keep_order=True), r.path("table"), r.path("ckpt"), trigger=AVAILABLE_NOW, **how)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replay(spark, sf_dir, "stream_upsert", _trip_slices, _upserted)
    return read_latest(spark, r.path("table")).select(*schemas.BOARD_COLUMNS)


def stream_upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink merges its folders in tiers as it goes."""
    r = _replay(spark, sf_dir, "stream_upsert_compacted", _trip_slices, partial(_upserted, merge_every=1, fanout=2))
    return read_latest(spark, r.path("table")).select(*schemas.BOARD_COLUMNS)


def stream_state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the unbounded join holds after the whole feed: rows by side. The
    stream's own session reads the state, by the replay's state settings."""
    seen: list[DataFrame] = []
    _replay(spark, sf_dir, "stream_state_rows", _trip_slices, _appended, then=lambda r: seen.append(settled(state_by_partition(r.stream_spark, r.path("ckpt")))))
    return seen[0].groupBy("side").agg(F.sum("rows").alias("rows"))


def _from_latest(r: FeedReplay):
    u, s = (r.envelopes(t, {"startingOffsets": "latest"}, r.path("ckpt")) for t in (UPDATES_TOPIC, STATUS_TOPIC))
    return write_append(board_stream(u, s, clock=FIXTURE_CLOCK), r.path("board"), r.path("ckpt"), trigger=AVAILABLE_NOW)


def stream_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first slice lies there when the stream first starts, and is passed
    over: a trip needs its update in the second and its status in the third."""
    r = _replay(spark, sf_dir, "stream_from_latest", _trip_slices, _from_latest)
    return read_board(spark, r.path("board"), missing_ok=True)


def rollup_trips_per_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per route kept up to date by the board stream, folded as it goes."""

    def start(r: FeedReplay):
        return write_rollup(_board_stream(r), r.path("rollup"), r.path("ckpt"), trigger=AVAILABLE_NOW, fold_every=1, fanout=2)

    return rollup.trips_per_route(spark, _replay(spark, sf_dir, "rollup", _trip_slices, start).path("rollup"))


def _dealt(rows: DataFrame, kind: str) -> Callable[[int], DataFrame]:
    """``rows`` computed once and written by their ``_batch``; the function that
    reads one batch from its own folder."""
    folder = working_folder(rows.sparkSession, kind)
    rows.write.partitionBy("_batch").parquet(folder)
    schema = T.StructType([*rows.drop("_batch").schema, T.StructField("_batch", T.LongType())])
    return lambda i: rows.sparkSession.read.schema(schema).parquet(folder).where(F.col("_batch") == i).drop("_batch")


def rollup_first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Future stops per trip in the earliest snapshot, from batches that come
    out of order, one of them twice, with folds in between."""
    board = spark.table(stored_board(spark, sf_dir))
    path = working_folder(spark, "rollup")
    part = F.pmod(F.xxhash64("tripId"), F.lit(5)).alias("_batch")
    batches = _dealt(board.select("tripId", "routeId", "currentTime", "numOfFutureStops", part), "rollup-batches")
    for batch_id in (3, 0, 4, 4, 1, 2):
        append_rollup(batches(batch_id), path, "writer", batch_id)
        fold_rollup(spark, path, fanout=2)
    return rollup.first_snapshot(spark, path)


# -- intake with dead letters ----------------------------------------------------------
KINDS = {"updates": UPDATES_TOPIC, "status": STATUS_TOPIC}


def _damaged(msgs: DataFrame) -> DataFrame:
    """Messages of every 17th trip are cut off half-way."""
    cut = F.pmod(F.col("key").cast("bigint"), F.lit(17)) == 3
    return msgs.withColumn("value", F.when(cut, F.expr("left(value, length(value) div 2)")).otherwise(F.col("value")))


def _taken_in(spark: SparkSession, sf_dir: str) -> FeedReplay:
    """The damaged feed parsed by two intake streams, with restarts."""
    r = _staged(spark, sf_dir, "intake", _trip_slices, change=_damaged)
    for i in range(3):
        r.deliver(f"slice = {i}")
        for kind, t in KINDS.items():
            write_intake(r.envelopes(t), kind, r.path(kind), r.path("ckpt", kind), trigger=AVAILABLE_NOW).awaitTermination()
    r.release_inputs()
    return r


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that did not parse."""
    r = _taken_in(spark, sf_dir)
    per = [read_dead_letters(spark, k, r.path(k)).select(F.lit(k).alias("kind"), "key", instant_to_utc("ingest_ts").alias("ingest_ts")) for k in KINDS]
    return per[0].unionByName(per[1])


def board_after_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board of the messages that did parse, not parsed again."""
    r = _taken_in(spark, sf_dir)
    u, s = (read_parsed(spark, k, r.path(k)) for k in KINDS)
    return derive_board(join_feeds(reshape_updates(u), reshape_status(s)), clock=FIXTURE_CLOCK)


def stream_latest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board appended, and its latest rows kept by a second stream that
    writes a trip's row only when it has changed."""
    r = _staged(spark, sf_dir, "stream_latest_changes", _trip_slices)
    for i in range(3):
        r.deliver(f"slice = {i}")
        write_append(_board_stream(r, keep_order=True), r.path("board"), r.path("ckpt"), trigger=AVAILABLE_NOW).awaitTermination()
        rows = r.stream_spark.readStream.schema(schemas.BOARD_WITH_ORDER).parquet(r.path("board"))
        write_latest(rows, r.path("table"), r.path("ckpt", "latest"), trigger=AVAILABLE_NOW).awaitTermination()
    r.release_inputs()
    return read_latest(spark, r.path("table")).select(*schemas.BOARD_COLUMNS)


def stream_upsert_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board in two batches with the second applied twice, as after a
    failure between writing and checkpointing, and merged in the end."""
    board = board_from_messages(messages(spark, sf_dir), keep_order=True)
    batches = _dealt(board.withColumn("_batch", F.pmod(F.col("u_hash"), F.lit(2))), "replayed-batches")
    path = working_folder(spark, "replayed")
    for batch_id in (0, 1, 1):
        append_latest(batches(batch_id), path, "writer", batch_id, "tripId", schemas.LATEST_ORDER)
    compact(spark, path)
    return read_latest(spark, path).select(*schemas.BOARD_COLUMNS)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "trip_board": trip_board,
        "trip_board_instant": trip_board_instant,
    }
    for name, fn in adhoc.QUERIES.items():
        q[name] = partial(_adhoc, fn)
    # On the live plan these need less than the whole board.
    q.update({"q2_count": q2_count, "q4_trips_per_route": q4_trips_per_route, "q9_first_snapshot": q9_first_snapshot})
    for name in SQL:
        q[f"sql_{name}"] = partial(_sql, name)
    q["sql_q5_started_between_1998"] = partial(_sql, "q5_started_between", lo=Q5_FIXTURE_WINDOW[0], hi=Q5_FIXTURE_WINDOW[1])
    q["sql_q9_pruned"] = sql_q9_pruned
    q["q5_started_between_1998"] = partial(_adhoc, partial(adhoc.q5_started_between, lo=Q5_FIXTURE_WINDOW[0], hi=Q5_FIXTURE_WINDOW[1]))
    q.update(
        {
            "latest_per_trip": latest_per_trip,
            "updates_parsed": updates_parsed,
            "status_parsed": status_parsed,
            "stops_reshaped": stops_reshaped,
            "status_normalised": status_normalised,
            "trip_join": trip_join,
            "feed_split": feed_split,
            "feed_compact": feed_compact,
            "feed_union": feed_union,
            "board_from_feed": board_from_feed,
            "board_default_clock": board_default_clock,
            "stream_append": stream_append,
            "stream_join_bounded": stream_join_bounded,
            "stream_late_dropped": stream_late_dropped,
            "stream_upsert": stream_upsert,
            "stream_upsert_replayed": stream_upsert_replayed,
            "stream_upsert_compacted": stream_upsert_compacted,
            "stream_latest_changes": stream_latest_changes,
            "stream_state_rows": stream_state_rows,
            "stream_from_latest": stream_from_latest,
            "rank_by_clock": rank_by_clock,
            "q9_ranked": q9_ranked,
            "sql_q5_clustered": sql_q5_clustered,
            "sql_lookup_by_trip": sql_lookup_by_trip,
            "board_bucketed": board_bucketed,
            "rollup_trips_per_route": rollup_trips_per_route,
            "rollup_first_snapshot": rollup_first_snapshot,
            "dead_letters": dead_letters,
            "board_after_intake": board_after_intake,
        }
    )
    return q
