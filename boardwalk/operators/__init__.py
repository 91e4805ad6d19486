"""DataFrame operators of the engine: each takes and returns DataFrames."""

from boardwalk.operators.board import derive_board
from boardwalk.operators.feed import split_feed, topic, union_feeds
from boardwalk.operators.join import heavy_trips, join_feeds
from boardwalk.operators.latest import latest_board, latest_per_key
from boardwalk.operators.rank import global_rank
from boardwalk.operators.reshape import reshape_status, reshape_updates

__all__ = [
    "derive_board",
    "global_rank",
    "heavy_trips",
    "join_feeds",
    "latest_board",
    "latest_per_key",
    "reshape_status",
    "reshape_updates",
    "split_feed",
    "topic",
    "union_feeds",
]
