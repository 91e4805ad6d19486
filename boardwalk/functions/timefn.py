"""Time functions of the board.

Every function here returns ``timestamp_ntz`` values that hold UTC wall-clock
time, and none depends on ``spark.sql.session.timeZone``: the same message
gives the same board on every cluster. All are built-in expressions, so they
stay inside whole-stage codegen; bad input gives null, never an error (ANSI
mode is on in Spark 4 and one malformed message must not stop a stream).

Two time modes:

* ``reference``: reproduces the original board under a UTC session. Epoch
  seconds and the clock are first rendered as UTC wall time and then shifted
  as if that wall time were local to ``shift_tz``; the trip start (a local
  date and time in the message) is converted from ``shift_tz`` to UTC.
* ``instant``: epochs and the clock are kept as the instants they are; the trip
  start is converted from ``source_tz`` (the feed's own zone) to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The zone the original board shifts every time through, and the
# zone of the transit feed's local start times.
REFERENCE_SHIFT_TZ = "America/Los_Angeles"
FEED_SOURCE_TZ = "America/New_York"

REFERENCE = "reference"
INSTANT = "instant"
MODES = (REFERENCE, INSTANT)

# Seconds between 0001-01-01 and 9999-12-31 23:59:59 relative to the epoch:
# the range a timestamp can hold. Epochs outside become null, not an overflow.
_MIN_EPOCH_S = -62135596800
_MAX_EPOCH_S = 253402300799


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"time mode must be one of {MODES}, got {mode!r}")
    return mode


def _days_since_epoch(ts_ntz: Column) -> Column:
    return F.datediff(F.to_date(ts_ntz), F.lit("1970-01-01").cast(T.DateType())).cast("bigint")


def epoch_seconds(ts_ntz: Column | str) -> Column:
    """Whole seconds since the epoch (floored) of a UTC wall-clock
    ``timestamp_ntz``. Field arithmetic only: Spark's ``timestampdiff`` casts
    ``timestamp_ntz`` to the session zone, which is off by an hour across a
    DST change in any zone that has one."""
    c = _col(ts_ntz)
    return (
        _days_since_epoch(c) * 86400
        + F.hour(c).cast("bigint") * 3600
        + F.minute(c).cast("bigint") * 60
        + F.second(c).cast("bigint")
    )


def _micros_in_second(ts_ntz: Column) -> Column:
    return F.pmod((F.date_part(F.lit("SECOND"), ts_ntz) * 1_000_000).cast("bigint"), F.lit(1_000_000))


def epoch_micros(ts_ntz: Column | str) -> Column:
    c = _col(ts_ntz)
    return epoch_seconds(c) * 1_000_000 + _micros_in_second(c)


def epoch_minutes(ts_ntz: Column | str) -> Column:
    """Whole minutes since the epoch (floored)."""
    c = _col(ts_ntz)
    return _days_since_epoch(c) * 1440 + F.hour(c).cast("bigint") * 60 + F.minute(c).cast("bigint")


def _div(x: Column, m: int) -> Column:
    """Integral division truncating toward zero; ``x`` is referenced once,
    so inlined inputs are not copied (a filter pushed below a projection gets
    its aliases inlined, and filters get no common-subexpression pass)."""
    return F.call_function("div", x, F.lit(m))


def epoch_text_seconds(text: Column | str) -> Column:
    """Epoch seconds from text as the original's implicit cast reads it:
    surrounding blanks allowed, a fractional part truncated (``"12.7"`` ->
    12), anything else (``"abc"``, ``"1e9"``) null. The fallback only runs
    when the plain cast fails."""
    t = F.trim(_col(text))
    whole = F.substring_index(t, ".", 1)
    frac = F.substring(t, F.length(whole) + 2, 1 << 30)
    fallback = F.when(
        t.contains(".") & frac.rlike("^[0-9]*$") & whole.rlike("^[+-]?[0-9]+$"), whole.try_cast("bigint")
    )
    # try_cast itself ignores surrounding blanks; the fallback runs only on failure
    return F.coalesce(_col(text).try_cast("bigint"), fallback)


def epoch_text_to_utc(text: Column | str) -> Column:
    """Epoch seconds as text (protobuf JSON prints int64 as text) to UTC wall
    time; null for text that is not a number or out of range."""
    secs = epoch_text_seconds(text)
    # One comparison, in double so that no input can overflow (secs appears
    # twice in all, not three times). Midpoint and half-width are exact in
    # double, so the bounds stay exact.
    mid, half = (_MIN_EPOCH_S + _MAX_EPOCH_S) / 2, (_MAX_EPOCH_S - _MIN_EPOCH_S) / 2
    in_range = F.abs(secs.cast("double") - F.lit(mid)) <= F.lit(half)
    return F.when(in_range, F.timestamp_add("SECOND", secs, epoch_ntz()))


def instant_to_utc(ts: Column | str) -> Column:
    """A ``timestamp`` (an instant) to its UTC wall time as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch_ntz())


def unix_seconds_of(ts: Column | str) -> Column:
    """Whole seconds since the epoch of an instant (``timestamp``)."""
    return F.unix_seconds(_col(ts))


def utc_to_instant(ts_ntz: Column | str) -> Column:
    """Inverse of :func:`instant_to_utc`: UTC wall time to an instant."""
    return F.timestamp_micros(epoch_micros(ts_ntz))


def truncate_to_second(ts_ntz: Column | str) -> Column:
    """Drop sub-second digits (the original formats to ``HH:mm:ss`` and back)."""
    c = _col(ts_ntz)
    return F.timestamp_add("MICROSECOND", -_micros_in_second(c), c)


def wall_to_utc(ts_ntz: Column | str, tz: str) -> Column:
    """Read a wall-clock time as local to ``tz`` and give its UTC wall time.
    A time in a DST gap moves forward; one in an overlap takes the earlier
    offset."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(ts_ntz))


def local_start(start_date: Column | str, start_time: Column | str) -> Column:
    """``yyyyMMdd`` date text plus ``HH:mm:ss`` time text as a wall-clock
    ``timestamp_ntz``; null for a bad date, an hour of 24 or more, or null input."""
    day = F.call_function("try_to_date", _col(start_date), F.lit("yyyyMMdd"))
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), _col(start_time))
    return truncate_to_second(text.try_cast(T.TimestampNTZType()))


def start_time(
    start_date: Column | str,
    start_time_text: Column | str,
    mode: str = REFERENCE,
    shift_tz: str = REFERENCE_SHIFT_TZ,
    source_tz: str = FEED_SOURCE_TZ,
) -> Column:
    tz = shift_tz if check_mode(mode) == REFERENCE else source_tz
    return wall_to_utc(local_start(start_date, start_time_text), tz)


def stop_time(epoch_text: Column | str, mode: str = REFERENCE, shift_tz: str = REFERENCE_SHIFT_TZ) -> Column:
    """Arrival or departure time of a stop from its epoch text."""
    utc = epoch_text_to_utc(epoch_text)
    return wall_to_utc(utc, shift_tz) if check_mode(mode) == REFERENCE else utc


def clock_time(clock_utc_ntz: Column, mode: str = REFERENCE, shift_tz: str = REFERENCE_SHIFT_TZ) -> Column:
    """The board clock (``currentTime``), truncated to the second."""
    t = truncate_to_second(clock_utc_ntz)
    return wall_to_utc(t, shift_tz) if check_mode(mode) == REFERENCE else t


def minutes_elapsed(start: Column | str, end: Column | str) -> Column:
    """Whole minutes elapsed from ``start`` to ``end``, truncated toward zero
    (``date_diff('minute', ..)`` in the Trino dialect)."""
    return _div(epoch_micros(end) - epoch_micros(start), 60_000_000)


def minute_boundaries(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (``DATEDIFF`` in
    dialects that count boundaries): difference of the floored epoch minutes."""
    return epoch_minutes(end) - epoch_minutes(start)
