"""The global rank leaves the table where it is when its values are few."""

from __future__ import annotations

import pytest

from boardwalk.operators import rank


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [0, rank.FEW_VALUES])
def test_few_ranks_do_not_move_the_table(spark, monkeypatch, few):
    monkeypatch.setattr(rank, "FEW_VALUES", few)
    df = spark.createDataFrame([(i, i % 5 if i % 7 else None) for i in range(200)], "id long, c long")
    out = rank.global_rank(df, "c")
    join = next(x for x in _plan(out).splitlines() if "<=>" in x)
    assert ("strategy=broadcast" in join) == (few > 0)
    values = sorted((v for _, v in df.collect()), key=lambda v: (v is None, v))
    assert all(r.rnk == values.index(r.c) + 1 for r in out.collect()) and out.count() == 200
