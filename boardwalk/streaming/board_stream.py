"""The trip board as a streaming DataFrame: the same operators as batch."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame

from boardwalk.functions.timefn import FEED_SOURCE_TZ, REFERENCE, REFERENCE_SHIFT_TZ
from boardwalk.operators import derive_board, join_feeds, reshape_status, reshape_updates
from boardwalk.operators.join import heavy_trips
from boardwalk.session import path_exists, read_text, write_text
from boardwalk.sources import parse_status, parse_updates


def board_stream(
    updates: DataFrame,
    status: DataFrame,
    mode: str = REFERENCE,
    clock: Column | str | None = None,
    bound: str | None = None,
    watermark: str | None = None,
    salt: int = 1,
    heavy: list[str] | None = None,
    keep_order: bool = False,
    shift_tz: str = REFERENCE_SHIFT_TZ,
    source_tz: str = FEED_SOURCE_TZ,
) -> DataFrame:
    """Envelope streams (``key, value, ingest_ts``) to board rows.

    ``clock=None`` stamps each row with the micro-batch time, as the original
    does; pass a column for repeatable results. ``bound`` switches the join to
    watermarked, time-bounded state, with ``watermark`` for the delay if that
    is another (see ``join_feeds``). ``salt`` spreads the trips of ``heavy``
    (None: all) over sub-keys; ``kept_heavy_trips`` finds and keeps them."""
    u = reshape_updates(parse_updates(updates))
    s = reshape_status(parse_status(status))
    joined = join_feeds(u, s, bound=bound, watermark=watermark, salt=salt, heavy=heavy)
    return derive_board(joined, mode=mode, clock=clock, shift_tz=shift_tz, source_tz=source_tz, keep_order=keep_order)


def kept_heavy_trips(history: DataFrame, checkpoint: str, share: float = 1 / 64) -> list[str]:
    """The heavy trips of a stream, found once and kept beside its checkpoint:
    from ``history`` (what the source holds of the updates when the stream is
    first started, read as a batch), then from the file in every restart."""
    spark, path = history.sparkSession, f"{checkpoint.rstrip('/')}.heavy.json"
    if not path_exists(spark, path):
        write_text(spark, path, json.dumps(heavy_trips(history, share)))
    return json.loads(read_text(spark, path))
