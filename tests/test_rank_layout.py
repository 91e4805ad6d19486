"""Global rank, the laid-out board, bucketed feeds: results and plans."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.operators import global_rank
from boardwalk.operators.rank import value_ranks
from boardwalk.plans import adhoc, registered, trip_board
from boardwalk.session import shared_dir
from boardwalk.sources.layout import PART, of_trips, read_clustered, started_between, write_clustered
from conftest import SF_SMALL, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _scanned(df) -> dict[str, int]:
    """Files read and rows that came out of the scans of ``df``, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    out, todo = {"numFiles": 0, "numOutputRows": 0}, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if name == "FileSourceScanExec":
            for k in out:
                out[k] += node.metrics().apply(k).value()
    return out


# -- rank --------------------------------------------------------------------------
@pytest.mark.parametrize(("descending", "nulls_last"), [(False, True), (True, False), (False, False)])
def test_global_rank_equals_the_window(spark, descending, nulls_last):
    """Ties, nulls, one value with a third of all rows, over many ranges."""
    data = [(i, None if i % 29 == 0 else 7 if i % 3 == 0 else i * 37 % 101) for i in range(900)]
    df = spark.createDataFrame(data, "id int, c int").repartition(5)
    how = f"c {'DESC' if descending else 'ASC'} NULLS {'LAST' if nulls_last else 'FIRST'}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(global_rank(df, "c", descending=descending, nulls_last=nulls_last))
        assert value_ranks(df, "c").count() == 102
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == rows(df.selectExpr("id", "c", f"CAST(rank() OVER (ORDER BY {how}) AS BIGINT) AS rnk"))


def test_global_rank_by_two_columns_empty_and_clash(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (1, "a"), (None, None)], "c int, d string")
    want = df.selectExpr("c", "d", "CAST(rank() OVER (ORDER BY c ASC NULLS LAST, d ASC NULLS LAST) AS BIGINT) AS rnk")
    assert rows(global_rank(df, ["c", "d"])) == rows(want)
    assert global_rank(df.limit(0), "c").collect() == []
    with pytest.raises(ValueError):
        global_rank(df, "c", name="d")


def test_rank_never_moves_the_board_into_one_partition(spark):
    board = spark.table(registered.stored_board(spark, SF_SMALL))
    ranked = adhoc.rank_by_clock(board)
    plan = _plan(ranked)
    assert "SinglePartition" not in plan
    # The only window orders the values of one range.
    assert all("_part" in w for w in re.findall(r"windowspecdefinition\(([^)]*)\)", plan))


# -- layout ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def clustered(spark):
    path = f"{shared_dir(spark)}/test-clustered-{uuid.uuid4().hex[:8]}"
    write_clustered(spark.table(registered.stored_board(spark, SF_SMALL)), path, "month")
    return path


def test_layout_keeps_the_board(spark, clustered):
    got = read_clustered(spark, clustered)
    assert rows(got.select(*schemas.BOARD_COLUMNS)) == rows(trip_board(spark, SF_SMALL))
    assert got.where(F.col("startTime").isNull() != F.col(PART).isNull()).count() == 0
    assert read_clustered(spark, f"{clustered}-none", missing_ok=True).count() == 0


def test_an_interval_reads_its_folders_only(spark, clustered):
    lo, hi = "1995-03-05 00:00:00", "1995-04-20 18:00:00"
    board = read_clustered(spark, clustered)
    asked = started_between(board, lo, hi, "month")
    plain = board.where(F.col("startTime").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
    assert rows(asked) == rows(plain) and asked.count() > 0
    assert re.search(r"PartitionFilters: \[[^\]]*startPart", _plan(asked))
    everything, few = _scanned(board.select("tripId"))["numFiles"], _scanned(asked.select("tripId"))["numFiles"]
    assert few * 10 < everything
    q5 = registered.sql_q5_clustered(spark, SF_SMALL)
    assert re.search(r"PartitionFilters: \[[^\]]*startPart", _plan(q5))


def test_a_lookup_skips_row_groups_by_bloom_filter(spark, tmp_path):
    """Every file's range of trip ids spans the one asked for: only the filter
    can rule it out."""
    board = spark.table(registered.stored_board(spark, SF_SMALL))
    path = f"{tmp_path}/b"
    write_clustered(board, path, "month")
    some = [r.tripId for r in board.select("tripId").distinct().orderBy("tripId").limit(200).collect()]
    there, absent = some[100], some[100] + "0x"
    assert rows(of_trips(read_clustered(spark, path), [there]).select(*schemas.BOARD_COLUMNS)) == rows(board.where(F.col("tripId") == there))
    all_rows = board.count()
    assert _scanned(of_trips(read_clustered(spark, path), [absent]).select("tripId"))["numOutputRows"] == 0
    assert 0 < _scanned(of_trips(read_clustered(spark, path), [there]).select("tripId"))["numOutputRows"] < all_rows / 10


def test_the_append_sink_lays_out_by_start(spark):
    from boardwalk.plans.board_plan import FIXTURE_CLOCK, messages
    from boardwalk.sources.envelope import read_envelope
    from boardwalk.streaming import AVAILABLE_NOW, board_stream, write_append

    root = f"{shared_dir(spark)}/test-layout-{uuid.uuid4().hex[:8]}"
    msgs = messages(spark, SF_SMALL)
    for t in ("trip_updates", "trip_status"):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    b = board_stream(read_envelope(spark, "json", path=f"{root}/in/trip_updates"),
                     read_envelope(spark, "json", path=f"{root}/in/trip_status"), clock=FIXTURE_CLOCK)
    write_append(b, f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW, by_start="month").awaitTermination()
    got = read_clustered(spark, f"{root}/out")
    assert rows(got.select(*schemas.BOARD_COLUMNS)) == rows(trip_board(spark, SF_SMALL))
    few = started_between(got, "1995-03-05 00:00:00", "1995-04-20 18:00:00", "month")
    assert _scanned(few.select("tripId"))["numFiles"] * 10 < _scanned(got.select("tripId"))["numFiles"]


def test_layout_units():
    from boardwalk.sources.layout import start_part

    with pytest.raises(ValueError):
        start_part(None, "year")


# -- bucketed feeds ----------------------------------------------------------------
def test_bucketed_join_has_no_exchange(spark):
    board = registered.board_bucketed(spark, SF_SMALL)
    plan = _plan(board)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan
    assert rows(board) == rows(trip_board(spark, SF_SMALL))


def test_stored_boards_follow_their_input(spark, tmp_path):
    """A changed input file is another board, in the same application."""
    d = str(tmp_path)
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    first = registered.stored_board(spark, d)
    assert registered.stored_board(spark, d) == first
    half = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{d}/orders.parquet")
    second = registered.stored_board(spark, d)
    assert second != first and spark.table(second).count() < spark.table(first).count()
