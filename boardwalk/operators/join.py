"""Join of trip updates with trip status on the four trip keys.

Inner equi-join, keys once in the output. Null keys never match, so
malformed messages disappear here. Semantics are many-to-many over all input:
every update of a trip pairs with every status of it.

* Batch: a shuffle (sort-merge) join on the keys; AQE splits a skewed key's
  partition at run time.
* ``salt`` spreads a trip over ``salt`` sub-keys (updates hashed into one,
  statuses copied to all). With ``heavy`` only the trips named there are
  spread; any other trip has one sub-key, and its statuses are stored once.
* Stream: a symmetric hash join with state in the state store. Unbounded by
  default (as the original); ``bound`` adds watermarks on both ingest times
  and a time range, so late rows are dropped and state is evicted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.schemas import TRIP_KEYS


def join_feeds(
    updates: DataFrame,
    status: DataFrame,
    bound: str | None = None,
    watermark: str | None = None,
    salt: int = 1,
    heavy: list[str] | None = None,
) -> DataFrame:
    """``updates``/``status`` as given by ``reshape_updates``/``reshape_status``.

    ``bound``: e.g. ``"1 hour"``; a status must arrive within this interval
    of the update (either side). ``watermark`` defaults to ``bound``.
    ``heavy``: the trip ids that ``salt`` spreads (None: all), a bounded list
    (``heavy_trips``). In a stream it must stay what it was when the checkpoint
    was made, as must ``salt``: state is not dealt anew.
    """
    if salt < 1:
        raise ValueError("salt must be >= 1")
    keys = list(TRIP_KEYS)
    salted = salt > 1 and (heavy is None or len(heavy) > 0)
    if salted:
        cells = F.lit(salt)
        if heavy is not None:
            cells = F.when(F.col("tripId").isin(*heavy), cells).otherwise(F.lit(1))
        updates = updates.withColumn("_salt", F.pmod(F.col("u_hash"), cells).cast("int"))
        status = status.withColumn("_salt", F.explode(F.sequence(F.lit(0), cells - 1)))
        keys.append("_salt")
    if bound is None:
        joined = updates.join(status, keys, "inner")
    else:
        wm = watermark or bound
        u = updates.withWatermark("u_ingest_ts", wm)
        s = status.withWatermark("s_ingest_ts", wm)
        s = s.select(*[F.col(c).alias(f"_s_{c}") if c in keys else F.col(c) for c in s.columns])
        cond = [u[c] == s[f"_s_{c}"] for c in keys]
        cond.append(s["s_ingest_ts"].between(
            u["u_ingest_ts"] - F.expr(f"INTERVAL {bound}"), u["u_ingest_ts"] + F.expr(f"INTERVAL {bound}")
        ))
        joined = u.join(s, cond, "inner").drop(*[f"_s_{c}" for c in keys])
        joined = joined.select(*keys, *[c for c in joined.columns if c not in keys])
    return joined.drop("_salt") if salted else joined


#: Trips that may be called heavy, items that a sketch tracks, and groups that
#: the tasks' sketches are merged in first.
HEAVY, TRACKED, GROUPS = 64, 16384, 64


def heavy_trips(messages: DataFrame, share: float = 1 / HEAVY, key: str = "key") -> list[str]:
    """The keys that hold more than ``share`` of all rows of ``messages``, at
    most ``HEAVY`` of them, in order.

    A frequent-items sketch of bounded size passes over the rows and names the
    candidates; a second pass counts those exactly. Null keys don't count."""
    if share * HEAVY < 1:
        raise ValueError(f"share must be 1/{HEAVY} or more")
    some = messages.where(F.col(key).isNotNull()).groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part"))
    some = some.agg(F.expr(f"approx_top_k_accumulate({key}, {TRACKED})").alias("sketch"))
    # Grouped, if by nothing: there is no sketch of no rows.
    top = some.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    likely = [r["item"] for r in top.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {HEAVY})"))).toDF("item", "count").collect()]
    if not likely:
        return []
    exact = messages.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(key) == k).alias(f"k{i}") for i, k in enumerate(likely)]).first()
    return sorted(k for i, k in enumerate(likely) if exact[f"k{i}"] > share * exact["all"])
