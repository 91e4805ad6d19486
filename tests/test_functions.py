"""Edge rows (FIXTURES §4) through the real operators, from hand-made
messages. Zone America/Los_Angeles, time mode ``reference`` unless noted."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.functions import compact_json, minute_boundaries, minutes_elapsed, normalise_status
from boardwalk.operators import derive_board, join_feeds, latest_per_key, reshape_status, reshape_updates
from boardwalk.sources import parse_status, parse_updates
from conftest import rows

T0 = dt.datetime(2022, 10, 12, 12, 0, 0)


def T0_NTZ():
    return F.lit("2022-10-12 12:00:00").cast("timestamp_ntz")


def envelopes(spark, values, ts=T0):
    data = [(str(i), v, ts) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.ENVELOPE)


def trip(trip_id="A", start_time="10:00:00", start_date="20221012", route="R1"):
    return {"tripId": trip_id, "startTime": start_time, "startDate": start_date, "routeId": route}


def update_msg(stops=None, **kw):
    m = {"trip": trip(**kw)}
    if stops is not None:
        m["stopTimeUpdate"] = stops
    return json.dumps(m)


def status_msg(status="STOPPED_AT", **kw):
    m = {"trip": trip(**kw), "currentStopSequence": 3, "timestamp": "1665590000", "stopId": "C1"}
    if status is not None:
        m["currentStatus"] = status
    return json.dumps(m)


def stop(arrival, stop_id, departure=None):
    s = {"stopId": stop_id}
    if arrival is not None:
        s["arrival"] = {"time": str(arrival)}
    if departure is not None:
        s["departure"] = {"time": str(departure)}
    return s


def board_of(spark, updates, statuses, mode="reference", clock=None):
    u = reshape_updates(parse_updates(envelopes(spark, updates)))
    s = reshape_status(parse_status(envelopes(spark, statuses)))
    c = T0_NTZ() if clock is None else clock
    return derive_board(join_feeds(u, s), mode=mode, clock=c)


def one(df):
    got = df.collect()
    assert len(got) == 1, got
    return got[0]


def test_malformed_and_null_messages_parse_to_nulls_and_vanish_in_join(spark):
    p = parse_updates(envelopes(spark, ["{bad", None]))
    got = p.select("tripId", "routeId", "stopTimeUpdate").collect()
    assert [tuple(r) for r in got] == [(None, None, None), (None, None, None)]
    b = board_of(spark, ["{bad", None], [status_msg(), "{bad"])
    assert b.count() == 0


def test_no_stop_list_and_empty_stop_list(spark):
    for stops in (None, []):
        r = one(board_of(spark, [update_msg(stops)], [status_msg()]))
        assert r.numOfFutureStops == 0
        assert r.nextStopId is None and r.nextStopArrivalTime is None
        assert r.lastStopId is None and r.lastStopArrivalTime is None


def test_first_stop_with_departure_only(spark):
    stops = [stop(None, "S1", 1665589000), stop(1665590060, "S2", 1665590120)]
    r = one(board_of(spark, [update_msg(stops)], [status_msg()]))
    assert r.numOfFutureStops == 2
    assert r.nextStopArrivalTime is None and r.nextStopId == "S1"
    assert r.lastStopId == "S2"
    assert r.lastStopArrivalTime == dt.datetime(2022, 10, 12, 22, 54, 20)


def test_ordinary_times_reference_mode(spark):
    r = one(board_of(spark, [update_msg([stop(1665590000, "S1")])], [status_msg()]))
    assert r.startTime == dt.datetime(2022, 10, 12, 17, 0, 0)
    assert r.nextStopArrivalTime == dt.datetime(2022, 10, 12, 22, 53, 20)
    # the clock (12:00 UTC wall) is shifted like every other time
    assert r.currentTime == dt.datetime(2022, 10, 12, 19, 0, 0)


def test_ordinary_times_instant_mode(spark):
    r = one(board_of(spark, [update_msg([stop(1665590000, "S1")])], [status_msg()], mode="instant"))
    assert r.startTime == dt.datetime(2022, 10, 12, 14, 0, 0)  # 10:00 in New York
    assert r.nextStopArrivalTime == dt.datetime(2022, 10, 12, 15, 53, 20)
    assert r.currentTime == T0


def test_board_does_not_depend_on_session_zone(spark):
    msgs = ([update_msg([stop(1665590000, "S1")])], [status_msg()])
    base = rows(board_of(spark, *msgs))
    try:
        for tz in ("Asia/Tokyo", "America/New_York", "America/Sao_Paulo", "Australia/Lord_Howe"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert rows(board_of(spark, *msgs)) == base, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minutes_across_dst_in_any_session_zone(spark):
    # 2022-03-13: New York skips 02:00-03:00; UTC wall times are unaffected.
    a, b = "2022-03-13 06:59:30", "2022-03-13 07:01:10"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = df.select(minutes_elapsed("a", "b"), minute_boundaries("a", "b")).first()
            assert tuple(got) == (1, 2), tz
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        far = spark.createDataFrame([("2022-01-10 12:00:00", "2022-07-10 12:00:00")], "a string, b string").select(
            minutes_elapsed(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))).first()[0]
        assert far == 181 * 24 * 60
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_hour_date_and_epoch_give_null_not_error(spark):
    cases = [
        dict(start_time="25:10:00"),
        dict(start_time="24:00:00"),
        dict(start_date="2022-10-12"),
    ]
    for kw in cases:
        r = one(board_of(spark, [update_msg([stop("abc", "S1")], **kw)], [status_msg(**kw)]))
        assert r.startTime is None, kw
        assert r.nextStopArrivalTime is None


def test_dst_gap_and_overlap(spark):
    gap = one(board_of(spark, [update_msg([], start_date="20220313", start_time="02:30:00")],
                       [status_msg(start_date="20220313", start_time="02:30:00")]))
    assert gap.startTime == dt.datetime(2022, 3, 13, 10, 30, 0)
    over = one(board_of(spark, [update_msg([], start_date="20221106", start_time="01:30:00")],
                        [status_msg(start_date="20221106", start_time="01:30:00")]))
    assert over.startTime == dt.datetime(2022, 11, 6, 8, 30, 0)


def test_status_normalisation(spark):
    df = spark.createDataFrame([("STOPPED_AT",), (None,), ("INCOMING_AT",), ("IN_TRANSIT_TO",)], "s string")
    got = [r[0] for r in df.select(normalise_status("s")).collect()]
    assert got == ["STOPPED_AT", "ON_THE_ROAD", "ON_THE_ROAD", "ON_THE_ROAD"]


def test_minute_semantics(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2022, 10, 12, 10, 0, 50), dt.datetime(2022, 10, 12, 10, 2, 10)),
         (dt.datetime(2022, 10, 12, 10, 2, 10), dt.datetime(2022, 10, 12, 10, 1, 50))],
        T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())]),
    )
    got = [tuple(r) for r in df.select(minutes_elapsed("a", "b"), minute_boundaries("a", "b")).collect()]
    assert got == [(1, 2), (0, -1)]


def test_compact_json(spark):
    df = spark.createDataFrame([('\n{ "routeId": "4-NOT SPECIFIED" }\t',)], "v string")
    assert df.select(compact_json("v")).first()[0] == '{"routeId":"4-NOTSPECIFIED"}'


def test_many_to_many_join_and_upsert(spark):
    ups = [update_msg([stop(1665590000, "S1")]), update_msg([stop(1665590100, "S2")])]
    sts = [status_msg("STOPPED_AT"), status_msg("IN_TRANSIT_TO")]
    u = reshape_updates(parse_updates(envelopes(spark, ups)))
    s = reshape_status(parse_status(envelopes(spark, sts)))
    joined = join_feeds(u, s)
    assert joined.count() == 4
    b = derive_board(joined, clock=T0_NTZ(), keep_order=True)
    assert latest_per_key(b, "tripId", schemas.LATEST_ORDER).count() == 1


def test_salted_join_equals_plain_join(spark):
    ups = [update_msg([stop(1665590000 + i, f"S{i}")], trip_id=f"T{i % 3}") for i in range(12)]
    sts = [status_msg(trip_id=f"T{i % 3}") for i in range(6)]
    u = reshape_updates(parse_updates(envelopes(spark, ups)))
    s = reshape_status(parse_status(envelopes(spark, sts)))
    plain = rows(join_feeds(u, s))
    assert len(plain) == 24
    assert rows(join_feeds(u, s, salt=4)) == plain


def test_epoch_text_is_read_like_the_original_cast(spark):
    from boardwalk.functions.timefn import epoch_text_seconds

    cases = ["1665590000", " 1665590000 ", "+1665590000", "1665590000.5", "-12.9", "1665590000.", "1e9", "abc", "1.2.3", "", None]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(epoch_text_seconds("t")).collect()]
    assert got == [1665590000, 1665590000, 1665590000, 1665590000, -12, 1665590000, None, None, None, None, None]


def test_epoch_range_bounds_and_overflow(spark):
    from boardwalk.functions import epoch_text_to_utc

    cases = ["-62135596800", "-62135596801", "253402300799", "253402300800", "9223372036854775807", "-9223372036854775808"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(epoch_text_to_utc("t")).collect()]
    assert got[0] == dt.datetime(1, 1, 1, 0, 0, 0) and got[2] == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert got[1] is None and got[3] is None and got[4] is None and got[5] is None


def test_stop_count_is_zero_for_null_with_ansi_off(spark):
    from boardwalk.functions import stop_count

    df = spark.createDataFrame([(None,), ([],), (["a", None],)], "a array<string>")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert [r[0] for r in df.select(stop_count("a")).collect()] == [0, 0, 2]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [r[0] for r in df.select(stop_count("a")).collect()] == [0, 0, 2]
