"""Sources: message envelopes, driver-table fixtures, the board at rest."""

from boardwalk.sources.envelope import parse_or_keep, parse_status, parse_updates, read_envelope
from boardwalk.sources.fixtures import feed_snapshots, trip_key_messages, trip_messages
from boardwalk.sources.table import read_board, register_board, register_board_path

__all__ = [
    "feed_snapshots",
    "parse_or_keep",
    "parse_status",
    "parse_updates",
    "read_board",
    "read_envelope",
    "register_board",
    "register_board_path",
    "trip_key_messages",
    "trip_messages",
]
