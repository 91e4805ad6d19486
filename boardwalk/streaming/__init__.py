"""Structured Streaming: the board stream, its sinks, intake, aggregates kept
up to date, state inspection, and feed replay."""

from boardwalk.sources.upsert import append_latest, compact, merge_tiers, read_latest
from boardwalk.streaming.board_stream import board_stream, kept_heavy_trips
from boardwalk.streaming.intake import read_dead_letters, read_parsed, write_intake
from boardwalk.streaming.latest import latest_changes, write_latest
from boardwalk.streaming.replay import FeedReplay
from boardwalk.streaming.rollup import append_rollup, fold_rollup, write_rollup
from boardwalk.streaming.sinks import AVAILABLE_NOW, merge_latest, publish, publish_stream, write_append, write_upsert
from boardwalk.streaming.state import hot_partitions, join_state, state_by_partition

__all__ = [
    "AVAILABLE_NOW",
    "FeedReplay",
    "append_latest",
    "append_rollup",
    "board_stream",
    "compact",
    "fold_rollup",
    "hot_partitions",
    "join_state",
    "kept_heavy_trips",
    "latest_changes",
    "merge_latest",
    "merge_tiers",
    "publish",
    "publish_stream",
    "read_dead_letters",
    "read_latest",
    "read_parsed",
    "state_by_partition",
    "write_append",
    "write_intake",
    "write_latest",
    "write_rollup",
    "write_upsert",
]
