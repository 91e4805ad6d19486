"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import settled


def _stars(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)`` (long ids, any
    direction, repeats allowed); ``root`` is the smallest node reachable.

    Alternates two contractions until nothing changes, a logarithmic number of
    rounds: every node's larger neighbours are tied to its smallest neighbour,
    then every node's smaller neighbours are. The edge count never grows. The
    minima are combined before the shuffle, and the joins on ``u`` are plain
    equi-joins that adaptive execution can split when one node is hot. Each
    round is written to the checkpoint folder. No edges: no rows.
    """
    e = settled(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct())
    seen = _stars(e)
    while seen[0]:
        both = e.union(e.selectExpr("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").selectExpr("v AS a", "m AS b", "u AS a2", "m AS b2")
        small = tied.selectExpr("explode(array(struct(a AS u, b AS v), struct(a2 AS u, b2 AS v))) AS p").select("p.*")
        e = settled(small.where("u <> v").distinct())
        now = _stars(e)
        if now == seen:
            break
        seen = now
    return e.selectExpr("u AS node", "v AS root").union(e.selectExpr("v AS node", "v AS root").distinct())
