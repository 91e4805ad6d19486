"""Rank of every row over the whole table, without a single-partition window.

``rank() over (order by c)`` sends all rows to one task. Here only the
distinct values of ``c`` are ordered, each with its number of rows:

1. count per value (combined before the shuffle: a value holding a third of
   all rows leaves each task as one row);
2. deal the values out by range, so that partition k's values come before
   partition k + 1's, and note each one's partition;
3. sum the counts per partition; one number per partition reaches the driver,
   which adds them up in order;
4. inside a partition, a value's rank is the partition's sum so far plus the
   counts before it plus one. All ties of a value share that one row, so they
   share its rank wherever their rows are.

The ranks are joined back by value: broadcast where the values, counted in step
3, are few, so that the table itself is not moved; otherwise it is a sort-merge
join that adaptive execution splits where a value is hot.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.session import settled


def _ordered(by: list[str], descending: bool, nulls_last: bool) -> list[Column]:
    how = ("desc" if descending else "asc") + ("_nulls_last" if nulls_last else "_nulls_first")
    return [getattr(F.col(c), how)() for c in by]


#: Distinct values up to which the ranks are broadcast.
FEW_VALUES = 1 << 17


def value_ranks(df: DataFrame, by: str | list[str], descending: bool = False, nulls_last: bool = True) -> DataFrame:
    """``by, n, before``: each distinct value of the ``by`` columns, its number
    of rows and the number of rows that come before it. Null is a value. Up to
    ``FEW_VALUES`` of them come with a broadcast hint."""
    by = [by] if isinstance(by, str) else list(by)
    order = _ordered(by, descending, nulls_last)
    values = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    # Written once: a repeated sampling could cut the ranges elsewhere.
    parted = settled(values.repartitionByRange(*order).select(*by, "n", F.spark_partition_id().alias("_part")))
    sums = sorted(tuple(r) for r in parted.groupBy("_part").agg(F.sum("n"), F.count(F.lit(1))).collect())
    starts = accumulate((n for _, n, _ in sums), initial=0)
    # A row per partition.
    offsets = df.sparkSession.createDataFrame([(p, o) for (p, _, _), o in zip(sums, starts, strict=False)], "_part int, _start long")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = parted.withColumn("_local", local).join(F.broadcast(offsets), "_part")
    out = ranked.select(*by, "n", (F.col("_start") + F.col("_local")).alias("before"))
    return F.broadcast(out) if sum(values for _, _, values in sums) <= FEW_VALUES else out


def global_rank(df: DataFrame, by: str | list[str], name: str = "rnk", descending: bool = False, nulls_last: bool = True) -> DataFrame:
    """``df`` with ``name``: what ``rank() over (order by <by>)`` gives, ties
    sharing the smallest rank. ``df`` is read twice (once for ``by`` alone):
    give it as a stored table, not as a live plan. No rows: no rows."""
    by = [by] if isinstance(by, str) else list(by)
    if name in df.columns:
        raise ValueError(f"the table has a column {name!r} already")
    ranks = value_ranks(df, by, descending, nulls_last)
    ranks = ranks.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], (F.col("before") + 1).alias(name))
    same = [df[c].eqNullSafe(ranks[f"_by_{i}"]) for i, c in enumerate(by)]
    return df.join(ranks, same, "inner").select(*[df[c] for c in df.columns], name)
