"""The source divergence audit against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import empty, lower, messy, messy_rows

from boardwalk.llm import divergence


def brute(rows, min_docs=3, top=200):
    """Rows ``(lang, source, text)`` to the audit's rows, in whole numbers."""
    group, holds, found = {}, Counter(), set()
    for lang, source, text in [tuple(x or "" for x in r) for r in rows]:
        terms = [lower(t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        group.setdefault((lang, source), Counter()).update(terms)
        holds.update((lang, t) for t in set(terms))
        found.add((lang, source))
    out = set()
    for lang in {g[0] for g in found}:
        kept = [t for (x, t), n in holds.items() if x == lang and n >= min_docs]
        mine = {s: group[lang, s] for x, s in found if x == lang}
        everything = sum(mine.values(), Counter())

        def price(counts, t, kept=kept):
            return 1 + 1_000_000_000 * (counts[t] + 1) // (sum(counts[k] for k in kept) + len(kept))

        p = {s: {t: price(c, t) for t in kept} for s, c in mine.items()}
        q = {t: price(everything, t) for t in kept}
        for s in mine:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in mine if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked)}
    return out


def _rows(df):
    return [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]


def _made(seed, sources, n):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}" + "xyz"[: i % 4] for i in range(60)]
    rows = []
    for i in range(n):
        s = rng.choice([0, 0, rng.randrange(sources)])
        text = " ".join(rng.choice(words[s % 7 :]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "de"]), f"s{s}", rng.choice([text, text.upper(), f"{text}\n{text}"])))
    return rows + [("xx", "alone", "one two"), ("yy", "a", None), ("yy", "b", "12 -- 34"), (None, None, "the the the"), (None, "k", "the THE"), ("", "k", "the")]


@pytest.mark.parametrize(("groups", "terms", "rows", "columns"), [(32, 1024, 128, 2048), (2, 9, 4, 5), (3, 7, 128, 2048)])
def test_audit_against_brute_force(spark, monkeypatch, groups, terms, rows, columns):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "TERMS", terms)
    made = _made(1, 9, 300)
    df = spark.createDataFrame(made, "lang string, source string, text string").repartition(3)
    got = _rows(divergence.audit(df, top=5))
    assert set(got) == brute(made, top=5) and len(got) == len(set(got))


@pytest.mark.parametrize(("rows", "columns"), [(128, 2048), (3, 4)])
def test_blocks_of_the_matrix(monkeypatch, rows, columns):
    """Joint tables priced block by block equal term-by-term sums."""
    monkeypatch.setattr(divergence, "ROWS", rows)
    monkeypatch.setattr(divergence, "COLUMNS", columns)
    rng = np.random.default_rng(2)
    levels = rng.poisson([0.3, 1, 5, 200, 0], (90, 5))
    prices = divergence._prices(levels, levels.sum(axis=0) + 90)
    for first in (np.ones(5, bool), np.array([True, False, True, False, False])):
        out = np.zeros((5, 5), np.int64)
        for k in range(0, 90, rows):
            divergence._joint(levels[k : k + rows], prices[k : k + rows], first, out)
        for g in range(5):
            for h in range(5):
                want = sum((int(a) - int(b)) ** 2 // int(b) for a, b in zip(prices[:, g], prices[:, h], strict=True))
                assert out[g, h] == (want if first.all() or first[g] != first[h] else 0)


def test_prices_are_exact():
    for n, size in ((0, 1), (3, 7), (10**13, 3 * 10**13 + 1), (9 * 10**14, 9 * 10**14 + 5)):
        assert divergence._prices(np.array([n]), np.array([size])).tolist() == [1 + 1_000_000_000 * (n + 1) // size]


def test_price_columns_are_exact(spark):
    rows = [(0, 0, 1), (3, 4, 3), (10**13, 3 * 10**13, 1), (9 * 10**17, 9 * 10**17, 5)]
    got = spark.createDataFrame(rows, "n long, total long, kept long").select("n", "total", "kept", divergence.price("n", "total", "kept").alias("p")).collect()
    assert {tuple(r) for r in got} == {(n, t, k, 1 + 1_000_000_000 * (n + 1) // (t + k)) for n, t, k in rows}


def test_messy_and_empty(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNTED", 5)
    got = _rows(divergence.audit(messy(spark)))
    assert set(got) == brute([(r[2], "src", r[1]) for r in messy_rows()]) and len(got) == len(set(got))
    assert divergence.audit(empty(spark)).collect() == []
