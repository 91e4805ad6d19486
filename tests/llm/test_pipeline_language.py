"""The pipeline's language stage: what the network found reaches the result."""

from __future__ import annotations

from functools import reduce


def test_language_found_is_what_follows_sees(spark):
    import corpus_pipeline as c

    # Two languages told apart by their letters; rows whose own label is none
    # or wrong get the one that their letters say.
    text = lambda i: " ".join(("aba abba" if i % 2 else "oxo xoxo") for _ in range(12 + i))
    rows = [(i, text(i), "ab" if i % 2 else "ox") for i in range(60)] + [(101, text(101), None), (100, text(100), "ab"), (102, "12 !", "ox"), (103, None, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = c.language_id(spark, docs, "")
    assert out.columns == docs.columns
    found = {r.doc_id: r for r in out.collect()}
    assert sorted(found) == [*range(60), 100, 101]
    assert (found[101].lang, found[100].lang) == ("ab", "ox")
    assert all(found[i].text == text(i) for i in found)
    last = c.STAGES[-1][1](spark, out, "")
    assert {r.doc_id: r.lang for r in last.collect()} == {i: r.lang for i, r in found.items()}


def test_stages_between_carry_the_language(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40).selectExpr("doc_id", "text", "concat('found-', doc_id) AS lang", "source", "n_chars")
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    out = reduce(lambda d, stage: stage[1](spark, d, sf), c.STAGES[1:], docs).collect()
    assert out and all(r.lang == f"found-{r.doc_id}" for r in out)
