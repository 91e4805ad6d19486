"""Classifiers, nearest neighbours, archives and the pipeline."""

import hashlib
import inspect
import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow.fs as pafs
import pytest
from cases import SF, empty, fold, messy, messy_rows, words
from pyspark.sql import functions as F

from boardwalk.llm import features, quality, queries, rabitq, toxicity, warc

MID = "/root/testdata/sf0.01"


def _auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / n / (len(label) - n)


# --- classifiers --------------------------------------------------------------


@pytest.mark.parametrize(("name", "column", "parts", "held", "least"), [("op6_toxicity", "toxic", 5, 0, 0.85), ("op9_quality", "quality", 3, 1, 0.95)])
def test_classifier_query_held_out(spark, name, column, parts, held, least):
    truth = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{MID}/labels.parquet'").fetchall())
    got = queries.queries()[name](spark, MID).collect()
    assert len(got) == 1000
    assert all(r.held_out == (fold(r.doc_id, parts) == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    rows = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert _auc(*np.array(rows).T) > least


@pytest.mark.parametrize("score", [toxicity.score, quality.score])
def test_classifiers_messy_and_empty(spark, score):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 0, 1), (20, 1, 0), (21, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = score(messy(spark), labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in messy_rows())
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5, 6)}) == 1  # no words: the bias alone
    assert score(empty(spark), labels).collect() == []
    assert all(0 <= r.score <= 1 for r in score(messy(spark), labels.limit(0)).collect())


@pytest.mark.parametrize("score", [toxicity.score, quality.score])
def test_rows_in_another_order_give_the_same_scores(spark, score):
    """Ids with several texts, and texts with several labels."""
    rows = [(i % 150, words(30, i, 200) + (" vile" if i % 5 == 0 else "")) for i in range(450)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(150)] + [(3, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = []
    for some in (rows, rows[::-1], rows[200:] + rows[:200]):
        df = spark.createDataFrame(some, "doc_id long, text string").repartition(1 + len(got))
        got.append(sorted((r.doc_id, r.score) for r in score(df, labels).collect()))
    assert got[0] == got[1] == got[2]


def test_toxicity_from_confirmed_texts_alone(spark):
    """No label says 0: the prior is estimated, or given."""
    docs = spark.createDataFrame([(i, words(40, i, 300) + (" vile words" if i % 5 == 0 else "")) for i in range(1500)], "doc_id long, text string")
    labels = docs.where("doc_id % 5 = 0 AND doc_id % 2 = 0").selectExpr("doc_id", "1 AS toxic")
    for prior in (None, 0.2):
        got = toxicity.score(docs, labels, prior=prior).collect()
        assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in got]) > 0.95, prior


@pytest.mark.parametrize("share", [0.02, 0.2, 0.6])
def test_share_of_positives_is_found(share):
    rng = np.random.default_rng(4)
    text = lambda bad: features.word_set((words(40, int(rng.integers(1 << 30)), 300) + (" vile" if bad else "")).encode())
    found = toxicity.mixture_share([text(True) for _ in range(800)], [text(rng.random() < share) for _ in range(4000)])
    assert abs(found - share) < 0.05
    assert toxicity.mixture_share([], []) == 0.5


def test_toxicity_where_every_text_is_labelled(spark):
    docs = spark.createDataFrame([(i, words(40, i, 300) + (" vile" if i % 5 == 0 else "")) for i in range(600)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 5 = 0 AS int) AS toxic")
    got = toxicity.score(docs, labels).collect()
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in got]) > 0.95


def test_nnpu_finds_positives_among_the_unlabelled():
    rng = np.random.default_rng(3)

    def text(bad):
        return features.word_set((words(40, int(rng.integers(1 << 30)), 300) + (" vile" if bad else "")).encode())

    prior = 0.2
    w, b = toxicity.fit_nnpu([text(True) for _ in range(300)], [text(rng.random() < prior) for _ in range(1500)], prior)
    score = lambda t: w[t[0]].sum() + b
    assert np.mean([score(text(True)) > 0 for _ in range(200)]) > 0.95
    assert np.mean([score(text(False)) > 0 for _ in range(200)]) < 0.05


def test_ftrl_separates_and_shrinks():
    rows = [(np.array([k % 2, 5]), np.array([1.0, 1.0]), k % 2) for k in range(200)]
    w, b = quality.fit_ftrl(rows)
    assert w[1] + w[5] + b > 0 > w[0] + w[5] + b and not w[6:].any()


def test_quality_learns_from_twelve_thousand(spark, monkeypatch):
    got = []
    monkeypatch.setattr(quality, "fit_ftrl", lambda rows: got.extend(rows))
    docs = spark.range(12_500).selectExpr("id AS doc_id", "concat('text ', id % 7) AS text")
    quality.fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality"), F.lit(True))
    assert len(got) == 12_000


# --- nearest neighbours ----------------------------------------------------------


def _nearest(rows, k):
    """Brute force; sums from the first component on, in double precision."""
    out = []
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ok = sorted({i: min(v for j, v in ok if j == i) for i, _ in ok}.items())
    for q, x in ok:
        if q % 20 == 0:
            found = []
            for i, v in ok:
                if i != q and len(v) == len(x):
                    s = 0.0
                    for a, b in zip(v, x, strict=True):
                        s += a * b
                    found.append((-s, i))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return out


def test_ann_query_recall(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = {(r.query_id, r.vec_id): (r["rank"], r.score) for r in queries.op1_rabitq_search(spark, SF).collect()}
    want = _nearest(rows, 20)
    assert len(got) == len(want)
    hit = [(q, i) in got for q, _, i, _ in want]
    assert np.mean(hit) >= 0.98
    assert all(abs(got[q, i][1] - s) < 1e-12 for q, _, i, s in want if (q, i) in got)


@pytest.mark.parametrize("blocks", [{}, {"vector_block": 9, "query_block": 2}])
def test_ann_messy(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(12)]) for i in range(60)]
    same = [float(x) for x in rng.standard_normal(12)]
    rows += [(100 + i, same) for i in range(50)] + [(100, same), (120, [1.0] * 12)]
    rows += [(None, same), (200, None), (220, []), (240, [0.0] * 12), (260, [float("nan")] + same[1:]), (280, [float("inf")] + same[1:]), (300, [None, *same[1:]])]
    rows += [(320, [1.0, 2.0]), (321, [2.0, 1.0]), (340, [3.0])]
    # A common offset: the centre matters.
    rows = [(i, [x + 0.5 for x in v] if v and len(v) == 12 and None not in v and any(v) else v) for i, v in rows]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, code int").repartition(3)
    got = sorted(map(tuple, rabitq.nearest(df, F.col("vec_id") % 20 == 0, 20, **blocks).collect()))
    want = sorted(_nearest(rows, 20))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [r[3] for r in want]
    assert rabitq.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_ann_estimate_and_bound():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((2000, 64)) + 1, rng.standard_normal(64)
    turn, centre = rabitq.rotation(64, 1), x.mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, r, f = rabitq.encode(x, centre, turn)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    guess = signs @ (q @ turn) / 8 / f * r + centre @ q
    error = 2.5 * r * np.sqrt(1 - f * f) / f * np.linalg.norm(q) / np.sqrt(63)
    assert (np.abs(guess - x @ q) <= error).mean() > 0.98


def test_ann_reranks_in_double_precision():
    """Products that single precision cannot tell apart, and large ones."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal(24)
    x = np.vstack([base * (1 + 1e-9 * rng.integers(-50, 50, (300, 1))), rng.standard_normal((300, 24)) * 1e6])
    ids, q = np.arange(600), np.vstack([base, base * 1e5])
    code, r, f = rabitq.encode(x, x.mean(axis=0), rabitq.rotation(24, 1))
    rows, cols, score = rabitq.search_block(np.array([-1, -2]), q, ids, x, code, r, f, x.mean(axis=0), rabitq.rotation(24, 1), 20, 50.0)
    every = rabitq.exact(x, np.tile(ids, 2), q, np.repeat([0, 1], 600)).reshape(2, 600)
    for n in (0, 1):
        want = sorted((-s, i) for i, s in enumerate(every[n].tolist()))[:20]
        assert sorted(zip((-score[rows == n]).tolist(), cols[rows == n].tolist(), strict=True)) == want


def test_ann_bound_fails_for_few():
    sure = inspect.signature(rabitq.search).parameters["sure"].default
    assert math.erfc(sure / math.sqrt(2)) / 2 < 0.01  # upper bounds below the truth, were the error Gaussian


# --- archives ---------------------------------------------------------------------


def _pages():
    big, other = "é<p>" + "x" * 1200, "y" * 999
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (7, "http://b/\r\nX: y", other), (8, "http://b/8", other), (9, "u", None), (10, "u", ""), (None, "n", big), (11, "r", "z" * 2000), (11, "r", "z" * 2000)]
    return rows + [(100 + i, f"http://c/{i}", f"page {i} " * (i + 1)) for i in range(60)]


def _plain(rows, least=1000):
    size = lambda h: len((h or "").encode())
    sha = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    best = {}
    for i, _, h in rows:
        if size(h) >= least:
            best[sha(h)] = max((x for x in (best.get(sha(h)), i) if x is not None), default=None)
    out, seen = [], set()
    for i, _, h in rows:
        d = sha(h)
        first = d in best and best[d] == i and d not in seen
        seen |= {d} if first else set()
        revisit = d in best and not first
        out.append((i, size(h), d, "revisit" if revisit else "response", best[d] if revisit else None))
    return Counter(out)


def test_warc_round_trip_shards_and_rolls(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, shard int").repartition(4)
    names = []
    for _ in range(2):
        uri = warc.write_archives(pages, warc.archive_folder(spark), shard_bytes=6000, roll_bytes=1500)
        got = warc.read_archives(spark, uri, with_payload=True)
        assert Counter(tuple(r)[:1] + tuple(r)[2:6] for r in got.collect()) == _plain(rows)
        by = {i: h for i, _, h in rows}
        assert all(r.payload == (by[r.page_id] or "").encode() for r in got.where("record_type = 'response' AND page_id IS NOT NULL").collect())
        files = spark.read.parquet(f"{uri}/manifest")
        names.append(sorted((r.name, r.bytes, r.sha256) for r in files.collect()))
        assert files.select("shard").distinct().count() > 2 and files.where("part > 0").count() > 0
        fs, folder = pafs.FileSystem.from_uri(uri)
        there = {x.base_name: x.size for x in fs.get_file_info(pafs.FileSelector(folder)) if x.base_name.endswith(".gz")}
        assert there == {n: b for n, b, _ in names[-1]}
        for n, _, sha in names[-1]:
            with fs.open_input_stream(f"{folder}/{n}", compression=None) as s:
                assert hashlib.sha256(s.read()).hexdigest() == sha
    assert names[0] == names[1]  # the same bytes each time


def _shards(spark, uri):
    return spark.read.parquet(f"{uri}/manifest").groupBy("shard").agg(F.sum("records").alias("records")).collect()


@pytest.mark.parametrize("copies", [4096, 7])
def test_warc_ids_and_pages_that_fill_a_shard(spark, monkeypatch, copies):
    """All ids null; one id throughout; one page throughout; one small page
    throughout: several shards each but for the page that is one chunk."""
    monkeypatch.setattr(warc, "COPIES", copies)
    monkeypatch.setattr(warc, "REMEMBERED", 2)
    tables = {
        "null ids": [(None, f"u{i}", f"page {i} " * 200) for i in range(250)],
        "one id": [(7, f"u{i % 9}", f"page {i} " * 200) for i in range(250)],
        "one page": [(7, "u", "x" * 3000)] * 250 + [(3, None, "x" * 3000)] * 30,
        "small page": [(7, "u", "x" * 900)] * 250,
    }
    for name, rows in tables.items():
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
        uri = warc.write_archives(pages, warc.archive_folder(spark), shard_bytes=20_000, roll_bytes=5000)
        got = warc.read_archives(spark, uri, with_payload=True).collect()
        assert Counter(tuple(r)[:1] + tuple(r)[2:6] for r in got) == _plain(rows), name
        assert all(len(r.payload) == r.payload_bytes for r in got if r.record_type == "response"), name
        shards = _shards(spark, uri)
        assert sum(r.records for r in shards) == len(rows)
        if copies == 7 or "page" not in name:
            assert len(shards) > 2 and max(r.records for r in shards) < len(rows) / 2, name


def test_warc_names_of_stores():
    assert warc.mapped("s3a://b/x") == warc.mapped("s3n://b/x") == "s3://b/x"
    assert [warc.mapped(u) for u in ("file:///x", "/x", "hdfs://n/x", "gs://b/x")] == ["file:///x", "/x", "hdfs://n/x", "gs://b/x"]
    with pytest.raises(ValueError, match="viewfs"):
        warc.mapped("viewfs://store/x")


def test_warc_refuses_a_chunk_without_its_html():
    chunk = {"shard": 0, "page_id": 1, "digest": "00" * 20, "url": "u", "chunk": True, "awaits": True, "start": 0, "copies": 2, "large": True, "n": 5, "html": None, "first_id": 1, "first_url": "u"}
    with pytest.raises(ValueError, match="missing"):
        list(warc._records(iter([chunk])))
    with pytest.raises(ValueError, match="missing"):
        list(warc._records(iter([chunk, chunk | {"page_id": 2}])))


def test_warc_without_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages, warc.archive_folder(spark))).collect() == []


def test_warc_notices_changes():
    data = warc.page_record(1, "u", b"hello", None, 0)
    headers, block = warc.parse_record(data)
    assert headers["WARC-Page-ID"] == "1" and block.endswith(b"hello")
    with pytest.raises(ValueError, match="changed"):
        warc.parse_record(data.replace(b"hello", b"hellO"))


# --- pipeline -----------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept.append(docs.count())
    assert kept[0] == kept[1] >= 195 and 0 < kept[3] <= kept[2] < kept[1]
    last = c.STAGES[-1][1](spark, docs, SF).drop("ids")
    whole = c.run(spark, SF).drop("ids")
    assert Counter(map(tuple, last.collect())) == Counter(map(tuple, whole.collect()))


def test_pipeline_messy_and_empty(spark):
    import corpus_pipeline as c

    for docs in (messy(spark), empty(spark)):
        for _, stage in c.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        rows = c.STAGES[-1][1](spark, docs, SF).collect()
        assert len(rows) == docs.count() == len({(r.doc_id, r.ids_sha256) for r in rows})


def test_pipeline_keeps_every_lettered_document(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    assert c.language_id(spark, docs, SF).count() == lettered.count() == 200
    # Nothing tells these six languages apart, so none gets a third.
    rows = [(i, words(20, i // 6), f"l{i % 6}") for i in range(120)] + [(200, "12 !", "l0"), (201, None, "l1"), (202, "a", None)]
    got = c.language_id(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), SF).collect()
    assert sorted(r.doc_id for r in got) == [*range(120), 202]
