"""From the driver's tables to the trip board, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from boardwalk.functions import clock_time
from boardwalk.functions.timefn import REFERENCE, REFERENCE_SHIFT_TZ
from boardwalk.operators import derive_board, join_feeds, latest_board, reshape_status, reshape_updates, topic
from boardwalk.operators.board import clock_column
from boardwalk.sources import parse_status, parse_updates, trip_key_messages, trip_messages
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC

# The clock of fixture boards: the update's ingest time, so results repeat.
FIXTURE_CLOCK = "u_ingest_ts"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The driver's tables have one row group each, so the orders are spread.
    return trip_messages(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), spread=True)


def key_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed for questions about trips and clocks alone."""
    return trip_key_messages(table(spark, sf_dir, "orders"), spread=True)


def feeds(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed and reshaped (updates, status) from routed messages."""
    u = reshape_updates(parse_updates(topic(msgs, UPDATES_TOPIC)))
    s = reshape_status(parse_status(topic(msgs, STATUS_TOPIC)))
    return u, s


def board_from_messages(
    msgs: DataFrame, mode: str = REFERENCE, clock: Column | str | None = FIXTURE_CLOCK, keep_order: bool = False
) -> DataFrame:
    u, s = feeds(msgs)
    return derive_board(join_feeds(u, s), mode=mode, clock=clock, keep_order=keep_order)


def board_keys(msgs: DataFrame, mode: str = REFERENCE, clock: str = FIXTURE_CLOCK) -> DataFrame:
    """``tripId, routeId, currentTime`` of every board row, for questions that
    need no more: only the messages' trips are parsed and joined."""
    u = parse_updates(topic(msgs, UPDATES_TOPIC), stops=False)
    s = parse_status(topic(msgs, STATUS_TOPIC), detail=False)
    joined = join_feeds(u, s)
    now = clock_time(clock_column(joined, clock), mode, REFERENCE_SHIFT_TZ)
    return joined.select("tripId", "routeId", now.alias("currentTime"))


def trip_board(spark: SparkSession, sf_dir: str, mode: str = REFERENCE) -> DataFrame:
    """The whole board of the fixture feed: every update x status pair."""
    return board_from_messages(messages(spark, sf_dir), mode=mode)


def latest_trip_board(spark: SparkSession, sf_dir: str, mode: str = REFERENCE) -> DataFrame:
    """One row per trip, the state the upsert sink converges to."""
    u, s = feeds(messages(spark, sf_dir))
    return latest_board(u, s, mode=mode, clock=FIXTURE_CLOCK)
