"""The queries that SQL can express, and what all queries return."""

import duckdb
import pytest
from cases import SF

from boardwalk.llm.oracles import oracle_sql
from boardwalk.llm.queries import queries

FIELDS = {
    "op1": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op2": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op5": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op6": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op8": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op11": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op13": {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint", "root": "string"},
}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries()[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle_sql()[name]})").fetchall()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(queries()))
def test_fields(spark, name):
    assert dict(queries()[name](spark, SF).dtypes) == FIELDS[name.split("_")[0]]
