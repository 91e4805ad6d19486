import re
from collections import Counter

import duckdb
import numpy as np
import xxhash
from cases import SF, empty, lower, messy, messy_rows

from boardwalk.llm import decontaminate, graph, line_dedup, queries, simhash


def _fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64))


def _components(rows, bits=4):
    """Brute force: smallest id reachable, by row index."""
    fps = [_fp(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for k in range(i):
            if (fps[i] ^ fps[k]).bit_count() <= bits and group[i] != group[k]:
                a, b = group[i], group[k]
                group = [b if g == a else g for g in group]
    low = {}
    for g, (i, _) in zip(group, rows, strict=True):
        low[g] = min((x for x in (low.get(g), i) if x is not None), default=None)
    return Counter((i, f"{f:016x}", low[g]) for (i, _), f, g in zip(rows, fps, group, strict=True))


def _op4(df):
    return Counter((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in df.collect())


def test_simhash_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.op4_simhash_groups(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == _components(docs)


def test_simhash_messy_and_empty(spark):
    assert _op4(simhash.simhash_groups(messy(spark))) == _components([r[:2] for r in messy_rows()])
    assert simhash.simhash_groups(empty(spark)).collect() == []


def test_positions_cover_every_guaranteed_match():
    from itertools import combinations

    for bits in range(8):
        sets = simhash.positions(bits)
        assert all(any(set(t) <= set(c) for t in sets) for c in combinations(range(8), 8 - bits))
    assert len(simhash.positions(4)) == 20


def _random_fps(spark, n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = []
    for i in range(n):
        f = int(centres[i % 6])
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            f ^= 1 << int(b)
        fps.append(f)
    return fps, spark.createDataFrame([(i, f - 2**64 if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")


def test_links_are_whole_in_any_blocking(spark):
    fps, df = _random_fps(spark, 240, 3)
    want = None
    for block in (7, 16384):
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, 4, block).collect()}
        assert want is None or got == want
        want = got
    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for k in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            assert want[i] == want[int(k)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5)]
    got = dict(tuple(r) for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_keep_one_of_each_group(spark):
    docs = messy(spark)
    kept = simhash.keep_one(docs, simhash.simhash_groups(docs))
    assert kept.columns == docs.columns
    of = _components([r[:2] for r in messy_rows()])
    groups = {c for _, _, c in of}
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert {i for i, _ in rows} == groups
    # Two components may be named by one id that has two texts.
    assert len(rows) == len(set(rows)) == len({_fp(t) for _, t in rows})
    assert Counter(i for i, _ in rows) == Counter({i: 1 + (i == 3) for i in groups})


# --- lines -----------------------------------------------------------------


def _drop(rows, least, keep_first=False):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    lines = [(t or "").split("\n") for _, t in rows]
    n = Counter(k for ls in lines for k in {key(x) for x in ls} if k)
    return [[x for x in ls if n[key(x)] < least] for ls in lines], lines


def test_line_dedup_messy(spark):
    rows = [r[:2] for r in messy_rows()]
    for least in (2, 10, 14):
        docs = messy(spark)
        got = line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs, min_docs=least))
        left, lines = _drop(rows, least)
        want = Counter((i, "\n".join(x), len(ls), len(ls) - len(x)) for (i, _), x, ls in zip(rows, left, lines, strict=True))
        assert Counter((r.doc_id, r["__kept"], r["__n_lines"], r["__n_dropped"]) for r in got.collect()) == want
    out = line_dedup.dedup_lines(messy(spark), min_docs=10)
    assert out.columns == messy(spark).columns
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.collect())
    assert line_dedup.dedup_lines(empty(spark)).collect() == []


def test_line_dedup_first_occurrence_stays(spark):
    docs = spark.createDataFrame([(1, "a\nb\nA"), (2, "b\n\nc"), (3, "B \nd")], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs, min_docs=2, keep_first=True)
    assert dict(tuple(r) for r in out.collect()) == {1: "a\nb\nA", 2: "\nc", 3: "d"}


def test_line_dedup_hot_line_takes_the_other_way(spark):
    """A line that fills more than its share is counted apart, with one result."""
    rows = [(i, f"hot\nonly {i}\nhot\npair {i // 12}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    at = line_dedup.line_hashes(docs).selectExpr("explode(lines) AS k").selectExpr("k.h", "k.g")
    assert line_dedup._hot(at).count() >= 1
    got = line_dedup.dedup_lines(docs, min_docs=10)
    assert {r.text for r in got.collect()} == {f"only {i}" for i in range(600)}


def test_bitmaps_are_compressed(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"{i} {k}" for k in range(200)) + "\nshared" if i < 10 else "own") for i in range(12)], "doc_id long, text string")
    got = line_dedup.line_bitmaps(docs, min_docs=10).collect()
    assert len(got) == 10 and all(r.keep == [-1, -1, -1, ~(1 << 8)] for r in got)


# --- benchmark --------------------------------------------------------------


def _contaminated(docs, items, window):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    out = []
    for i, t in docs:
        ws, hit, ids = cut(t), set(), set()
        for item, it in items:
            iw = cut(it)
            for s in range(max(len(iw) - window, 0) + 1) if iw else []:
                w = iw[s : s + window]
                for p in range(len(ws) - len(w) + 1):
                    if ws[p : p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        ids.add("" if item is None else str(item))
        out.append((i, len(ws), len(hit), ",".join(sorted(ids))))
    return Counter(out)


def test_contamination_messy(spark):
    docs = [r[:2] for r in messy_rows() if r[0] != 8] + [(40, "a b, C!d x"), (41, "the the the the"), (42, "b a")]
    text = docs[0][1]
    items = [(1, text[:60]), (2, " ".join(text.split()[5:25])), (10, "The"), (3, "b c d"), (4, None), (5, "??"), (2, "x y2z"), (None, "Straße"), (6, "a b c d x"), (7, "never seen words at all " * 3)]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    docs_df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, pos int").repartition(3)
    for window in (3, 10):
        found = decontaminate.contamination(docs_df, items_df, window)
        got = Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in found.collect())
        assert got == _contaminated(docs, items, window)
        kept = decontaminate.drop_contaminated(docs_df, found)
        assert Counter(r.doc_id for r in kept.collect()) == Counter(i for (i, _, n, _), k in got.items() if not n for _ in range(k))


def test_contamination_without_rows_or_items(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(empty(spark), items).collect() == []
    got = decontaminate.contamination(messy(spark), items.limit(0))
    assert got.count() == len(messy_rows()) and got.where("n_hit > 0").count() == 0


def test_bitmap_follows_the_benchmark():
    assert [decontaminate.bitmap_bits(n) for n in (0, 1000, 1 << 18, (1 << 18) + 1, 10**6, 10**9)] == [22, 22, 22, 23, 24, 25]


def test_hot_keys_from_sketches_in_groups(spark, monkeypatch):
    """The two levels report every key over the share, and none of no rows."""
    rows = [(1 if i % 3 == 0 else 2 if i % 5 == 0 else i + 10,) for i in range(6000)]
    at = spark.createDataFrame(rows, "h long").repartition(7)
    monkeypatch.setattr(line_dedup, "GROUPS", 3)
    assert {r.h for r in line_dedup._hot(at).collect()} == {1, 2}
    assert line_dedup._hot(at.limit(0)).collect() == []
