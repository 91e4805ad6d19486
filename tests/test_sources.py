"""Board at rest and message publishing."""

import uuid

from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.operators import split_feed, union_feeds
from boardwalk.plans import trip_board
from boardwalk.plans.board_plan import messages, table
from boardwalk.session import list_dir, shared_dir
from boardwalk.sources import feed_snapshots, read_board, read_envelope, register_board, register_board_path
from boardwalk.sources.fixtures import FEEDS, STATUS_TOPIC, UPDATES_TOPIC
from boardwalk.streaming import publish
from conftest import SF_SMALL, rows


def test_register_board_path_and_sql(spark):
    path = f"{shared_dir(spark)}/test-reg-{uuid.uuid4().hex[:8]}"
    b = trip_board(spark, SF_SMALL)
    b.write.parquet(path)
    register_board_path(spark, path, "board_tbl")
    got = spark.sql("select routeId, count(tripId) as numOfTrips from board_tbl group by routeId")
    want = b.groupBy("routeId").agg(F.count("tripId").alias("numOfTrips"))
    assert rows(got) == rows(want)
    register_board_path(spark, path, "transit.board_tbl")
    assert spark.table("transit.board_tbl").count() == b.count()
    register_board(spark, read_board(spark, path), "board_view")
    assert spark.table("board_view").count() == b.count()


def test_publish_files_then_read_envelopes(spark):
    path = f"{shared_dir(spark)}/test-pub-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    publish(msgs, "json", path=path)
    assert sorted(list_dir(spark, path)) == sorted(["_SUCCESS", f"topic={STATUS_TOPIC}", f"topic={UPDATES_TOPIC}"])
    env = read_envelope(spark, "json", path=f"{path}/topic={UPDATES_TOPIC}", stream=False)
    assert env.schema == schemas.ENVELOPE
    assert env.count() == msgs.where(F.col("topic") == UPDATES_TOPIC).count()


def test_split_feed_one_entity_with_both_parts(spark):
    snaps = feed_snapshots(table(spark, SF_SMALL, "orders"), table(spark, SF_SMALL, "lineitem"))
    split = split_feed(snaps)
    direct = messages(spark, SF_SMALL)
    # Same messages as the producer publishes directly, text included.
    assert rows(split.select("topic", "key", "value")) == rows(direct.select("topic", "key", "value"))
    per_feed = [snaps.where(F.col("feed") == i) for i in range(FEEDS)]
    assert union_feeds(*per_feed).count() == snaps.count()


def test_every_route_has_a_feed(spark):
    """Lettered routes and a null one: the union of the feeds is the feed."""
    routes = F.array(*[F.lit(r) for r in ("A", "SI", "J", "7", "")], F.lit(None).cast("string"))
    orders = table(spark, SF_SMALL, "orders").withColumn("o_orderpriority", routes[F.pmod(F.col("o_orderkey"), F.lit(6)).cast("int")])
    snaps = feed_snapshots(orders, table(spark, SF_SMALL, "lineitem"))
    per_feed = [snaps.where(F.col("feed") == i) for i in range(FEEDS)]
    united = split_feed(union_feeds(*per_feed))
    assert united.count() == split_feed(snaps).count()
    assert rows(united.groupBy("topic").count()) == rows(split_feed(snaps).groupBy("topic").count())


def test_times_survive_json_to_the_microsecond(spark):
    path = f"{shared_dir(spark)}/test-us-{uuid.uuid4().hex[:8]}"
    msgs = spark.sql("SELECT 'trip_updates' AS topic, 'k' AS key, 'v' AS value, TIMESTAMP'2022-10-12 10:00:00.123456' AS ingest_ts")
    publish(msgs, "json", path=path)
    env = read_envelope(spark, "json", path=f"{path}/topic=trip_updates", stream=False)
    assert rows(env, ["ingest_ts"]) == rows(msgs, ["ingest_ts"])


def test_registered_board_shows_rows_appended_later(spark):
    path = f"{shared_dir(spark)}/test-fresh-{uuid.uuid4().hex[:8]}"
    b = trip_board(spark, SF_SMALL)
    b.limit(1).write.parquet(path)
    name = f"fresh_{uuid.uuid4().hex[:8]}"
    register_board_path(spark, path, name)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 1
    b.limit(1).write.mode("append").parquet(path)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 2


def test_missing_connector_gives_a_clear_error(spark):
    import pytest

    with pytest.raises(RuntimeError, match="connector not installed"):
        read_envelope(spark, "kafka", {"kafka.bootstrap.servers": "localhost:1", "subscribe": "t"})


def test_scale_settings_grow_with_input():
    from boardwalk.session import scale_settings

    small = scale_settings(10 * 1024**3)
    big = scale_settings(50 * 1024**4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 50 * 1024**4 // 4 // (256 * 1024**2)
    assert int(scale_settings(800 * 1024**4)["spark.sql.shuffle.partitions"]) == 16 * int(big["spark.sql.shuffle.partitions"])


def test_sql_forms_equal_dataframe_forms(spark):
    from boardwalk.plans import adhoc
    from boardwalk.plans.sql import SQL, run_sql

    board = trip_board(spark, SF_SMALL)
    register_board(spark, board, "board_sql")
    window = {"lo": "1998-01-01 00:00:00", "hi": "1998-06-30 18:00:00"}
    for name in SQL:
        params = window if name == "q5_started_between" else {}
        got = run_sql(spark, name, "board_sql", **params)
        fn = adhoc.QUERIES[name]
        want = fn(board, **params) if params else fn(board)
        assert got.columns == want.columns, name
        assert rows(got) == rows(want), name


def test_merge_latest_reaches_the_catalog_and_cleans_up(spark):
    """No MERGE-capable format is installed: the statement reaches Spark,
    which rejects it for a Parquet table, and the batch view is dropped."""
    import pytest

    from boardwalk import schemas as sch
    from boardwalk.plans.board_plan import board_from_messages
    from boardwalk.streaming import merge_latest

    b = board_from_messages(messages(spark, SF_SMALL), keep_order=True)
    name = f"merge_target_{uuid.uuid4().hex[:8]}"
    b.limit(0).write.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    with pytest.raises(Exception, match="MERGE|UNSUPPORTED"):
        merge_latest(b, name, "tripId", sch.LATEST_ORDER)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("_boardwalk_batch_")]


def test_register_board_path_refuses_a_managed_table(spark):
    import pytest

    name = f"managed_{uuid.uuid4().hex[:8]}"
    spark.range(3).write.option("path", f"{shared_dir(spark)}/{name}-data").saveAsTable(name)  # external: replaced
    path = f"{shared_dir(spark)}/test-reg2-{uuid.uuid4().hex[:8]}"
    trip_board(spark, SF_SMALL).write.parquet(path)
    register_board_path(spark, path, name)
    assert spark.table(name).count() == trip_board(spark, SF_SMALL).count()
    managed = f"managed_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {managed} (x INT) USING parquet")
    with pytest.raises(ValueError, match="managed"):
        register_board_path(spark, path, managed)


def test_q4_sql_and_dataframe_order_nulls_alike(spark):
    from boardwalk.plans import adhoc
    from boardwalk.plans.sql import run_sql

    board = trip_board(spark, SF_SMALL)
    with_null = board.unionByName(board.limit(3).withColumn("routeId", F.lit(None).cast("string")))
    register_board(spark, with_null, "board_nulls")
    got = [tuple(r) for r in run_sql(spark, "q4_trips_per_route", "board_nulls").collect()]
    want = [tuple(r) for r in adhoc.q4_trips_per_route(with_null).collect()]
    assert got == want and got[-1][0] is None


def test_read_board_missing_folder(spark):
    import pytest

    missing = f"{shared_dir(spark)}/never-written-{uuid.uuid4().hex[:8]}"
    with pytest.raises(Exception):
        read_board(spark, missing).count()
    empty = read_board(spark, missing, missing_ok=True)
    assert empty.count() == 0 and empty.columns == trip_board(spark, SF_SMALL).columns
