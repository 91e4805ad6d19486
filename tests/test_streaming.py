"""Streams: stream equals batch, upsert properties, bounded join."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.operators import latest_board, latest_per_key
from boardwalk.plans import trip_board
from boardwalk.plans.board_plan import FIXTURE_CLOCK, board_from_messages, feeds, messages
from boardwalk.plans.registered import stream_append, stream_upsert
from boardwalk.session import list_dir, shared_dir
from boardwalk.sources.envelope import read_envelope
from boardwalk.sources.upsert import DELTAS, append_latest, compact, read_deltas, read_latest
from boardwalk.streaming import AVAILABLE_NOW, board_stream, write_append, write_upsert
from conftest import SF_SMALL, rows


def test_stream_append_equals_batch_board(spark):
    assert rows(stream_append(spark, SF_SMALL)) == rows(trip_board(spark, SF_SMALL))


def test_stream_upsert_equals_latest_board(spark):
    assert rows(stream_upsert(spark, SF_SMALL)) == rows(
        latest_per_key(trip_board(spark, SF_SMALL), "tripId", ["currentTime"])
    )


def test_latest_board_equals_latest_of_full_join(spark):
    msgs = messages(spark, SF_SMALL)
    full = board_from_messages(msgs, keep_order=True)
    want = latest_per_key(full, "tripId", schemas.LATEST_ORDER).select(*schemas.BOARD_COLUMNS)
    u, s = feeds(msgs)
    assert rows(latest_board(u, s, clock=FIXTURE_CLOCK)) == rows(want)


def _path(spark):
    return f"{shared_dir(spark)}/test-upsert-{uuid.uuid4().hex[:8]}"


def _apply(path, batch, batch_id, writer="w"):
    append_latest(batch, path, writer, batch_id, "tripId", schemas.LATEST_ORDER)


def _slices(spark):
    b = board_from_messages(messages(spark, SF_SMALL), keep_order=True)
    k = F.col("tripId").cast("bigint")
    return [b.where(F.pmod(k, F.lit(3)) == i) for i in range(3)] + [b.where(F.col("u_ingest_ts").isNotNull())]


def test_upsert_one_row_per_key_and_idempotent_replay(spark):
    t = _path(spark)
    parts = _slices(spark)
    assert read_latest(spark, t).count() == 0
    _apply(t, parts[0], 0)
    first, deltas = rows(read_latest(spark, t)), read_deltas(spark, t).count()
    _apply(t, parts[0], 0)  # a replayed batch replaces itself
    assert rows(read_latest(spark, t)) == first and read_deltas(spark, t).count() == deltas
    _apply(t, parts[0], 1)  # and once more under another id changes nothing
    assert rows(read_latest(spark, t)) == first
    for i, p in enumerate(parts[1:], start=2):
        _apply(t, p, i)
    table = read_latest(spark, t)
    assert table.count() == table.select("tripId").distinct().count()


def test_upsert_order_insensitive(spark):
    parts = _slices(spark)
    a, b = _path(spark), _path(spark)
    for i, p in enumerate(parts):
        _apply(a, p, i)
    for i, p in enumerate(reversed(parts)):
        _apply(b, p, i)
    assert rows(read_latest(spark, a)) == rows(read_latest(spark, b))


def test_a_small_batch_writes_only_itself(spark):
    t = _path(spark)
    parts = _slices(spark)
    _apply(t, parts[3], 0)
    before = read_deltas(spark, t).count()
    _apply(t, parts[0].limit(8), 1)
    assert read_deltas(spark, t).count() - before <= 8
    _apply(t, parts[0].limit(0), 2)  # no rows: no folder
    assert list_dir(spark, f"{t}/{DELTAS}/writer=w") == ["batch=0", "batch=1"]


def test_compaction_keeps_rows_and_waits_for_readers(spark):
    t = _path(spark)
    for i, p in enumerate(_slices(spark)):
        _apply(t, p, i)
    want = rows(read_latest(spark, t))
    compact(spark, t)
    assert len(list_dir(spark, f"{t}/{DELTAS}/writer=w")) == 4  # still there for open queries
    assert rows(read_latest(spark, t)) == want
    compact(spark, t, keep_s=0)
    assert list_dir(spark, f"{t}/{DELTAS}/writer=w") == []
    assert len(list_dir(spark, f"{t}/{DELTAS}/writer=compacted")) == 1
    assert rows(read_latest(spark, t)) == want
    assert read_deltas(spark, t).count() == len(want)
    _apply(t, _slices(spark)[0], 0)  # a replay after compaction is harmless
    assert rows(read_latest(spark, t)) == want


def test_upsert_path_reads_and_registers_as_latest_rows(spark):
    from boardwalk.sources import read_board, register_board_path

    t = _path(spark)
    for i, p in enumerate(_slices(spark)):
        _apply(t, p, i)
    want = rows(read_latest(spark, t).select(*schemas.BOARD_COLUMNS))
    assert rows(read_board(spark, t)) == want
    name = f"latest_{uuid.uuid4().hex[:8]}"
    register_board_path(spark, t, name)
    assert rows(spark.newSession().table(name), schemas.BOARD_COLUMNS) == want


def _write_envelopes(spark, folder, values):
    spark.createDataFrame(values, schemas.ENVELOPE).coalesce(1).write.mode("append").json(folder)


def test_bounded_join_drops_late_rows_and_evicts_state(spark):
    root = f"{shared_dir(spark)}/test-bounded-{uuid.uuid4().hex[:8]}"
    u_dir, s_dir = f"{root}/u", f"{root}/s"

    def upd(trip_id, ts):
        return (trip_id, json.dumps({"trip": {"tripId": trip_id, "startTime": "10:00:00", "startDate": "20221012", "routeId": "R"}}), ts)

    def sts(trip_id, ts):
        return (trip_id, json.dumps({"trip": {"tripId": trip_id, "startTime": "10:00:00", "startDate": "20221012", "routeId": "R"},
                                     "currentStatus": "STOPPED_AT"}), ts)

    t0 = dt.datetime(2022, 10, 12, 10, 0)
    _write_envelopes(spark, u_dir, [upd("A", t0), upd("B", t0)])
    _write_envelopes(spark, s_dir, [sts("A", t0)])

    def run():
        b = board_stream(read_envelope(spark, "json", path=u_dir), read_envelope(spark, "json", path=s_dir),
                         clock=F.col("u_ingest_ts"), bound="10 minutes")
        q = write_append(b, f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW)
        q.awaitTermination()
        return q

    run()
    # Time moves on by a day: the watermark passes A and B.
    later = t0 + dt.timedelta(days=1)
    _write_envelopes(spark, u_dir, [upd("C", later)])
    _write_envelopes(spark, s_dir, [sts("C", later)])
    run()
    # A status for B, a day late: dropped, B never joins.
    _write_envelopes(spark, s_dir, [sts("B", t0)])
    _write_envelopes(spark, u_dir, [upd("D", later + dt.timedelta(minutes=1))])
    q = run()
    out = spark.read.schema(schemas.BOARD).parquet(f"{root}/out")
    assert sorted(r.tripId for r in out.collect()) == ["A", "C"]
    progress = [p for p in q.recentProgress if p.get("stateOperators")]
    ops = progress[-1]["stateOperators"][0]
    assert ops["numRowsDroppedByWatermark"] >= 1
    # Left in state: C's update and status, D's update; A and B were evicted.
    assert ops["numRowsTotal"] == 3


def test_app_json_source_upsert_sink_registers_view(spark):
    from boardwalk.app import parser, start
    from boardwalk.plans.board_plan import messages
    from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC

    root = f"{shared_dir(spark)}/test-app-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    for t in (UPDATES_TOPIC, STATUS_TOPIC):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    args = parser().parse_args([
        "--source", "json", "--updates-path", f"{root}/in/{UPDATES_TOPIC}", "--status-path", f"{root}/in/{STATUS_TOPIC}",
        "--sink", "upsert", "--path", f"{root}/table", "--checkpoint", f"{root}/ckpt",
        "--trigger", "available_now", "--register-as", "board_latest",
    ])
    start(spark, args).awaitTermination()
    view = spark.newSession().table("board_latest")
    assert view.count() == view.select("tripId").distinct().count() == trip_board(spark, SF_SMALL).select("tripId").distinct().count()


def test_producer_stream_splits_and_publishes(spark):
    from boardwalk.app import parser, start
    from boardwalk.plans.board_plan import table
    from boardwalk.sources import feed_snapshots
    from boardwalk.sources.fixtures import FEEDS, STATUS_TOPIC, UPDATES_TOPIC

    root = f"{shared_dir(spark)}/test-producer-{uuid.uuid4().hex[:8]}"
    snaps = feed_snapshots(table(spark, SF_SMALL, "orders"), table(spark, SF_SMALL, "lineitem"))
    for i in range(FEEDS):
        snaps.where(F.col("feed") == i).select("value", "ingest_ts").write.json(f"{root}/feed{i}")
    argv = ["--role", "producer", "--sink", "files", "--path", f"{root}/out", "--checkpoint", f"{root}/ckpt",
            "--trigger", "available_now"]
    for i in range(FEEDS):
        argv += ["--snapshots-path", f"{root}/feed{i}"]
    start(spark, parser().parse_args(argv)).awaitTermination()
    got = spark.read.json(f"{root}/out")
    want = messages(spark, SF_SMALL)
    for t in (UPDATES_TOPIC, STATUS_TOPIC):
        g = got.where(F.col("topic") == t).select("key", "value")
        w = want.where(F.col("topic") == t).select("key", "value")
        assert rows(g) == rows(w), t


def test_upsert_stream_recovers_from_a_failed_batch(spark, monkeypatch):
    """The first batch fails after its rows are written (as if the driver died
    before the checkpoint): the query fails, a restart replays the batch, and
    the table is right before and after."""
    import pytest
    from pyspark.errors import StreamingQueryException

    from boardwalk.streaming import sinks

    root = f"{shared_dir(spark)}/test-fail-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    for t in ("trip_updates", "trip_status"):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    real, calls = sinks.append_latest, {"n": 0}

    def flaky(*args):
        real(*args)
        calls["n"] += 1
        if calls["n"] == 1:
            raise OSError("simulated failure after the write")

    monkeypatch.setattr(sinks, "append_latest", flaky)

    def run():
        b = board_stream(read_envelope(spark, "json", path=f"{root}/in/trip_updates"),
                         read_envelope(spark, "json", path=f"{root}/in/trip_status"),
                         clock=FIXTURE_CLOCK, keep_order=True)
        write_upsert(b, f"{root}/table", f"{root}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()

    with pytest.raises(StreamingQueryException, match="simulated failure"):
        run()
    run()
    assert calls["n"] >= 2
    want = latest_per_key(trip_board(spark, SF_SMALL), "tripId", ["currentTime"])
    got = read_latest(spark, f"{root}/table").select(*schemas.BOARD_COLUMNS)
    assert rows(got) == rows(want)
    assert read_deltas(spark, f"{root}/table").count() == len(rows(want))


def test_salted_stream_join_equals_plain(spark):
    root = f"{shared_dir(spark)}/test-salt-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    for t in ("trip_updates", "trip_status"):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    b = board_stream(read_envelope(spark, "json", path=f"{root}/in/trip_updates"),
                     read_envelope(spark, "json", path=f"{root}/in/trip_status"), clock=FIXTURE_CLOCK, salt=3)
    write_append(b, f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()
    got = spark.read.schema(schemas.BOARD).parquet(f"{root}/out")
    assert rows(got) == rows(trip_board(spark, SF_SMALL))


def test_app_bounded_salted_instant_mode_equals_batch(spark):
    from boardwalk.app import parser, start

    root = f"{shared_dir(spark)}/test-app2-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    for t in ("trip_updates", "trip_status"):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    args = parser().parse_args([
        "--source", "json", "--updates-path", f"{root}/in/trip_updates", "--status-path", f"{root}/in/trip_status",
        "--sink", "append", "--path", f"{root}/out", "--checkpoint", f"{root}/ckpt", "--trigger", "available_now",
        "--time-mode", "instant", "--bound", "1 hour", "--salt", "2", "--state-partitions", "4",
    ])
    start(spark, args).awaitTermination()
    got = spark.read.schema(schemas.BOARD).parquet(f"{root}/out")
    want = trip_board(spark, SF_SMALL, mode="instant")
    # the CLI stamps rows with the batch clock; compare everything else
    cols = [c for c in schemas.BOARD_COLUMNS if c != "currentTime"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_registered_streams_on_an_empty_feed(spark, tmp_path):
    """Tables with no orders: every stream entry returns an empty board."""
    from boardwalk.plans.registered import stream_append, stream_join_bounded, stream_upsert

    d = str(tmp_path)
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    for fn in (stream_append, stream_join_bounded, stream_upsert):
        out = fn(spark, d)
        assert out.count() == 0 and out.columns == schemas.BOARD_COLUMNS, fn.__name__


def test_upsert_with_a_recreated_checkpoint_is_a_new_writer(spark):
    """Batch ids restart at 0 under a checkpoint recreated at the same path;
    they must be applied, not taken for replays of the old query's batches."""
    from boardwalk.session import delete_path

    root = f"{shared_dir(spark)}/test-reckpt-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    k = F.col("key").cast("bigint")

    def add(part):
        for t in ("trip_updates", "trip_status"):
            part_msgs = msgs.where((F.col("topic") == t) & (F.pmod(k, F.lit(2)) == part))
            part_msgs.select("key", "value", "ingest_ts").write.mode("append").json(f"{root}/in{part}/{t}")

    def run(part):
        b = board_stream(read_envelope(spark, "json", path=f"{root}/in{part}/trip_updates"),
                         read_envelope(spark, "json", path=f"{root}/in{part}/trip_status"),
                         clock=FIXTURE_CLOCK, keep_order=True)
        write_upsert(b, f"{root}/table", f"{root}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()

    add(0)
    run(0)
    delete_path(spark, f"{root}/ckpt")  # the operator starts over at the same path
    add(1)
    run(1)
    want = latest_per_key(trip_board(spark, SF_SMALL), "tripId", ["currentTime"])
    assert rows(read_latest(spark, f"{root}/table").select(*schemas.BOARD_COLUMNS)) == rows(want)


def test_stream_session_keeps_state_in_rocksdb_and_its_own_partitions(spark):
    from boardwalk.session import STREAM_CONF, stream_session

    plain = spark.newSession()
    for k in STREAM_CONF:
        plain.conf.unset(k)
    before = plain.conf.get("spark.sql.shuffle.partitions")
    s = stream_session(plain, 3)
    assert "RocksDB" in s.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert s.conf.get("spark.sql.shuffle.partitions") == "3"
    assert plain.conf.get("spark.sql.shuffle.partitions") == before
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)


def test_replay_stages_one_file_per_slice_and_topic(spark):
    from boardwalk.plans.registered import _time_slices
    from boardwalk.streaming import FeedReplay

    msgs = messages(spark, SF_SMALL)
    r = FeedReplay(spark, "test-stage")
    r.stage(msgs, _time_slices(msgs))
    staged = spark.read.parquet(r.path("stage"))
    files = staged.select("slice", "topic", F.input_file_name().alias("f")).distinct()
    folders = staged.select("slice", "topic").distinct().count()
    assert folders > 50 and files.count() == folders
    r.deliver("slice < 199501")
    r.deliver("slice >= 199501")
    got = r.spark.read.parquet(r.path("in", "trip_updates"))
    assert rows(got, ["key", "value", "ingest_ts"]) == rows(msgs.where("topic = 'trip_updates'"), ["key", "value", "ingest_ts"])


def test_latest_board_takes_the_source_zone(spark):
    msgs = messages(spark, SF_SMALL)
    u, s = feeds(msgs)
    got = latest_board(u, s, mode="instant", clock=FIXTURE_CLOCK, source_tz="Europe/London")
    from boardwalk.operators import derive_board, join_feeds

    full = derive_board(join_feeds(u, s), mode="instant", clock=FIXTURE_CLOCK, source_tz="Europe/London", keep_order=True)
    assert rows(got) == rows(latest_per_key(full, "tripId", schemas.LATEST_ORDER).select(*schemas.BOARD_COLUMNS))


def test_app_asks_for_a_path_only_where_it_is_used(spark):
    import pytest

    from boardwalk.app import parser, start

    with pytest.raises(SystemExit, match="needs --path"):
        start(spark, parser().parse_args(["--sink", "append", "--checkpoint", "c"]))
    with pytest.raises(Exception, match="(?i)kafka"):
        snaps = f"{shared_dir(spark)}/test-snaps-{uuid.uuid4().hex[:8]}"
        spark.createDataFrame([], schemas.SNAPSHOT_FILE).write.json(snaps)
        start(spark, parser().parse_args(["--role", "producer", "--sink", "kafka", "--snapshots-path", snaps, "--checkpoint", f"{snaps}-c"]))


def test_bounded_streams_are_salted(spark, monkeypatch):
    """Salted for a trip with a third of all updates, with the plain join's rows."""
    from boardwalk.plans import registered

    seen = []

    def noted(*inputs, salt=1, **how):
        seen.append(salt)
        return board_stream(*inputs, salt=salt, **how)

    monkeypatch.setattr(registered, "board_stream", noted)
    streams = (registered.stream_join_bounded, registered.stream_late_dropped)
    salted = [rows(fn(spark, SF_SMALL)) for fn in streams]
    assert len(seen) == 5 and min(seen) >= 2
    monkeypatch.setattr(registered, "_salt", lambda r: 1)
    assert [rows(fn(spark, SF_SMALL)) for fn in streams] == salted and all(salted)
