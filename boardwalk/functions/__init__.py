"""Column functions: built-in Spark expressions only, no Python UDFs."""

from boardwalk.functions.arrays import first_item, last_item, stop_count
from boardwalk.functions.text import compact_json, normalise_status
from boardwalk.functions.timefn import (
    INSTANT,
    REFERENCE,
    clock_time,
    epoch_micros,
    epoch_minutes,
    epoch_seconds,
    epoch_text_to_utc,
    instant_to_utc,
    local_start,
    minute_boundaries,
    minutes_elapsed,
    start_time,
    stop_time,
    truncate_to_second,
    unix_seconds_of,
    utc_to_instant,
    wall_to_utc,
)

__all__ = [
    "INSTANT",
    "REFERENCE",
    "clock_time",
    "compact_json",
    "epoch_micros",
    "epoch_minutes",
    "epoch_seconds",
    "epoch_text_to_utc",
    "first_item",
    "instant_to_utc",
    "last_item",
    "local_start",
    "minute_boundaries",
    "minutes_elapsed",
    "normalise_status",
    "start_time",
    "stop_count",
    "stop_time",
    "truncate_to_second",
    "unix_seconds_of",
    "utc_to_instant",
    "wall_to_utc",
]
