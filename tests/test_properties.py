"""Property tests (hypothesis): latest-per-key and the upsert table."""

import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from boardwalk.operators import latest_per_key
from boardwalk.session import shared_dir
from boardwalk.sources.upsert import append_latest, compact, read_latest

ROW = st.tuples(
    st.sampled_from(["a", "b", "c", "d", "e"]),          # key
    st.integers(min_value=0, max_value=5),               # order 1
    st.one_of(st.none(), st.integers(0, 3)),             # order 2 (nullable)
    st.integers(min_value=0, max_value=10**6),           # payload / tiebreak
)
SCHEMA = "k string, o1 int, o2 int, v int"
ORDER = ["o1", "o2", "v"]
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _best(rows):
    """Python reference: max by (o1, o2, v) per key, nulls lowest."""
    out = {}
    for r in rows:
        key = (r[1], (r[2] is not None, r[2] if r[2] is not None else 0), r[3])
        if r[0] not in out or key > out[r[0]][0]:
            out[r[0]] = (key, r)
    return sorted(v[1] for v in out.values())


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[3])))
def test_latest_per_key_matches_reference(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(tuple(r) for r in latest_per_key(df, "k", ORDER).collect())
    assert got == _best(data)


@SETTINGS
@given(
    st.lists(ROW, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[3])),
    st.lists(st.integers(0, 2), min_size=30, max_size=30),
    st.permutations([0, 1, 2]),
)
def test_upsert_any_split_any_order_equals_latest(spark, data, parts, order):
    path = f"{shared_dir(spark)}/prop-{uuid.uuid4().hex[:8]}"
    batches = [[r for r, p in zip(data, parts) if p == i] for i in range(3)]
    batch_id, schema = 0, spark.createDataFrame([], SCHEMA).schema
    for i in order:
        if batches[i]:
            append_latest(spark.createDataFrame(batches[i], SCHEMA), path, "w", batch_id, "k", ORDER)
            batch_id += 1
    # all of it once more, under the id of a batch to come
    append_latest(spark.createDataFrame(data, SCHEMA), path, "w", batch_id, "k", ORDER)
    compact(spark, path, "k", ORDER, schema, keep_s=0)
    got = sorted(tuple(r) for r in read_latest(spark, path, "k", ORDER, schema).select("k", "o1", "o2", "v").collect())
    assert got == _best(data)
