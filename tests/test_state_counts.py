"""The join's state counted by its stores of counts, and read once."""

from pyspark.sql import functions as F

from boardwalk.plans import registered
from boardwalk.streaming import hot_partitions, join_state, state_by_partition
from conftest import SF_SMALL, rows


def test_state_is_counted_without_reading_its_rows(spark):
    """Trips updated twice among them; as many rows as are held, found by one
    scan a side of the store that has a count per key."""
    seen = {}

    def look(r):
        s, at = r.stream_spark, r.path("ckpt")
        by = state_by_partition(s, at)
        seen["plan"] = by._jdf.queryExecution().executedPlan().toString()
        seen["hot"] = hot_partitions(s, at, 0.0)._jdf.queryExecution().executedPlan().toString()
        seen["got"] = rows(by.select("side", "partition_id", "rows"))
        held = join_state(s, at)
        seen["want"] = rows(held.groupBy("side", "partition_id").agg(F.count(F.lit(1)).alias("rows")))
        seen["twice"] = held.groupBy("side", "key").count().where("count > 1").count()
        seen["shares"] = [x["share"] for x in by.groupBy("side").agg(F.sum("share").alias("share")).collect()]

    registered._replay(spark, SF_SMALL, "test-counts", registered._trip_slices, registered._appended, then=look)
    assert seen["got"] == seen["want"] and seen["twice"] > 0
    assert all(abs(x - 1) < 1e-9 for x in seen["shares"]) and len(seen["shares"]) == 2
    for plan in (seen["plan"], seen["hot"]):
        assert plan.count("BatchScan StateTable") == 2 and "keyToNumValues" in plan and "joinSide=left" not in plan


def test_state_rows_without_a_store_of_counts(spark, monkeypatch):
    """Another state format has no such store: then the rows are counted."""
    from boardwalk.streaming import state

    seen = {}

    def look(r):
        s, at = r.stream_spark, r.path("ckpt")
        want = rows(state_by_partition(s, at))
        monkeypatch.setattr(state, "operators", lambda spark, _: spark.createDataFrame([], "operatorId bigint, stateStoreName string"))
        seen["same"] = rows(state_by_partition(s, at)) == want and len(want) > 0

    registered._replay(spark, SF_SMALL, "test-counts", registered._trip_slices, registered._appended, then=look)
    assert seen["same"]
