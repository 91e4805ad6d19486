"""How a language's sources differ in their words, exactly.

A group is a (language, source). Each language keeps the terms found in enough
of its documents. A group's probability of a term depends on the term's count
there alone, its *level*: p = 1 + floor(SCALE * (count + 1) / (N + V)), with N
the group's occurrences of kept terms and V the number of kept terms. The
divergence of p from q at a term is floor((p - q)^2 / q), in whole numbers.

Pairs of sources. Summing over terms would price every term for every pair of
groups. Instead terms are rows of an indicator matrix with a column per
(group, level), 0 included, and the matrix's transpose times itself holds, for
every pair of groups, the joint table of their levels: how many terms have
level a in one and b in the other. Terms are dealt into units; a unit orders
its terms by frequency, so that blocks of rows share few levels, multiplies
block by block in 32-bit floats (counts of ``ROWS`` terms at most: exact) and
prices each joint count once. Groups are dealt into parts as well, and a unit
holds one pair of parts, so neither a language with many terms nor one with
many sources meets whole in a task.

Terms of a source. Each term that a group has and that is likelier there than
in its language, the ``top`` most divergent ones.

Nulls and repeats: null text, language and source are ''. Every row is a
document, repeated ones too. A group whose documents have no terms is a group.
No rows: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, settled, ship, split_words

#: One, as a probability.
SCALE = 1_000_000_000
#: Terms of a unit, and groups of a part of a language's groups.
TERMS, GROUPS = 1024, 32
#: Rows and columns of a block of the indicator matrix.
ROWS, COLUMNS = 128, 2048
#: Distinct (language, source, term) a task counts before it passes them on.
COUNTED = 1 << 19
#: Parts that rows are dealt into where a key may hold most of them.
SALT = 32
#: Documents that hold a group's own row: more than any term is asked for.
_ALWAYS = 1 << 40

# ASCII letters in lower case and all bytes of other code points; else a blank.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, sources, counts``: what a task found of a term: the number
    of documents that hold it (first in ``counts``), and its occurrences by
    source. Rows with term '' name all groups, those without terms too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def part() -> Iterator[pa.RecordBatch]:
            parts = []
            for (lang, source), (n, has) in groups.items():
                size = len(n) + 1
                term = pa.array([b"", *n], pa.binary()).cast(pa.string())
                counts, found = pa.array([0, *n.values()], pa.int64()), pa.array([_ALWAYS, *map(has.__getitem__, n)], pa.int64())
                parts.append(pa.table([pa.repeat(pa.scalar(lang), size), pa.repeat(pa.scalar(source), size), term, counts, found], names=["lang", "source", "term", "n", "docs"]))
            if parts:
                by = pa.concat_tables(parts).group_by(["lang", "term"], use_threads=False)
                t = by.aggregate([("docs", "sum"), ("source", "list"), ("n", "list")]).combine_chunks()
                for b in t.to_batches(1 << 16):
                    starts = b["n_list"].offsets.to_numpy()
                    counts = np.insert(b["n_list"].flatten().to_numpy(), starts[:-1] - starts[0], b["docs_sum"].to_numpy())
                    lists = pa.ListArray.from_arrays(pa.array(starts - starts[0] + np.arange(len(starts)), pa.int32()), pa.array(counts))
                    yield pa.RecordBatch.from_arrays([b["lang"], b["term"], b["source_list"], lists], ["lang", "term", "sources", "counts"])

        held = 0
        for b in batches:
            texts = b.column(2).cast(pa.large_binary())
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, strict=True):
                n, has = groups.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                mine: set[bytes] = set()
                for words in split_words(text.as_py().translate(_TERMS)):
                    n.update(words)
                    mine.update(words)
                has.update(mine)
                held += len(n) - before
                if held >= COUNTED:
                    yield from part()
                    groups.clear()
                    held = 0
        yield from part()

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return arrow_rows(docs.select(blank("lang"), blank("source"), blank("text")), run, "lang string, term string, sources array<string>, counts array<long>")


def kept_entries(counts: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, in_all``: the terms in ``min_docs`` documents of
    a language or more, as each group has them, with the language's own count;
    and each group with term ''. Rare terms go before they are spread out, and
    all of it follows one exchange by term."""
    by = counts.repartition("lang", "term")
    # Both readers of the exchange ask for all its columns, so that it is one.
    in_all = F.sum(F.expr("aggregate(counts, -counts[0], (a, x) -> a + x)")).alias("in_all")
    kept = by.groupBy("lang", "term").agg(F.sum(F.col("counts")[0]).alias("in_docs"), in_all, F.max(F.size("sources")).alias("most"))
    kept = kept.where((F.col("in_docs") >= min_docs) & (F.col("most") > 0)).select("lang", "term", "in_all")
    at = by.join(kept.hint("shuffle_hash"), ["lang", "term"])
    at = at.select("lang", "term", "in_all", F.explode(F.arrays_zip("sources", F.expr("slice(counts, 2, size(counts))").alias("n"))).alias("x"))
    at = at.select("lang", "term", "in_all", F.col("x.sources").alias("source"), F.col("x.n").alias("n"))
    return at.groupBy("lang", "term", "source", "in_all").agg(F.sum("n").alias("n")).select("lang", "source", "term", "n", "in_all")


def price(count: str, total: str, kept: str) -> Column:
    """p of a count, in decimals wide enough for any long."""
    wide = lambda c: f"cast({c} AS decimal(20, 0))"
    return F.expr(f"1 + (cast({SCALE} AS decimal(10, 0)) * {wide(f'{count} + 1')}) div {wide(f'{total} + {kept}')}")


def _prices(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p of counts where N + V is ``size``: long division by thousands."""
    p, rest = np.divmod(count + 1, size)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, size)
        p = p * 1000 + more
    return p + 1


def _diverging(p, q):
    return (p - q) ** 2 // q


def _joint(levels: np.ndarray, prices: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out[g, h]`` the divergence of group g from group h, for g of
    one part (``first``) and h of the other, over a block of terms. ``levels``
    and ``prices``: terms by groups."""
    rows, groups = levels.shape
    # A column per (group, level) of the block.
    column = np.empty(levels.shape, np.int64)
    price_of, group_of, width = [], [], 0
    for g in range(groups):
        _, at, of = np.unique(levels[:, g], return_index=True, return_inverse=True)
        column[:, g] = of + width
        width += len(at)
        price_of.append(prices[at, g])
        group_of.append(np.full(len(at), g))
    p, group = np.concatenate(price_of), np.concatenate(group_of)
    ones = np.zeros((rows, width), np.float32)
    np.put_along_axis(ones, column, 1, axis=1)
    mine, others = np.flatnonzero(first[group]), np.flatnonzero(~first[group]) if not first.all() else np.arange(width)
    for i in range(0, len(mine), COLUMNS):
        a = mine[i : i + COLUMNS]
        for j in range(0, len(others), COLUMNS):
            b = others[j : j + COLUMNS]
            table = ones[:, a].T @ ones[:, b]
            x, y = np.nonzero(table)
            times = table[x, y].astype(np.int64)
            x, y = a[x], b[y]
            np.add.at(out, (group[x], group[y]), times * _diverging(p[x], p[y]))
            if not first.all():
                np.add.at(out, (group[y], group[x]), times * _diverging(p[y], p[x]))


_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _unit(keys: tuple, entries: pa.Table, groups: pa.Table) -> pa.Table:
    """The pairs of one unit: ``lang, source, item, value`` over its terms."""
    lang, lo, hi = keys[0].as_py(), keys[2].as_py(), keys[3].as_py()
    if not groups.num_rows:
        return _SUMS.empty_table()
    source = groups.column("source").to_pylist()
    where = {s: i for i, s in enumerate(source)}
    first = groups.column("part").to_numpy() == lo
    size = groups.column("size").to_numpy()
    out = np.zeros((len(source), len(source)), np.int64)
    if entries.num_rows and (lo == hi or first.any() and not first.all()):
        # Terms by descending frequency; entries without a source name them.
        named = entries.filter(pc.is_null(entries.column("source")))
        total = named.column("n").to_numpy()
        order = np.argsort(-total, kind="stable")
        row = dict(zip(named.column("term").take(pa.array(order)).to_pylist(), range(len(order)), strict=True))
        found = entries.filter(pc.is_valid(entries.column("source")))
        levels = np.zeros((len(row), len(source)), np.int64)
        r = np.fromiter(map(row.__getitem__, found.column("term").to_pylist()), np.int64, found.num_rows)
        c = np.fromiter(map(where.__getitem__, found.column("source").to_pylist()), np.int64, found.num_rows)
        levels[r, c] = found.column("n").to_numpy()
        prices = _prices(levels, size)
        for k in range(0, len(row), ROWS):
            _joint(levels[k : k + ROWS], prices[k : k + ROWS], first, out)
    g, h = np.nonzero((first[:, None] != first[None, :]) if lo != hi else ~np.eye(len(source), dtype=bool))
    names = pa.array(source, pa.string())
    return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "source": names.take(pa.array(g)), "item": names.take(pa.array(h)), "value": pa.array(out[g, h])})


def _parted(groups: DataFrame) -> DataFrame:
    """``groups`` with ``part`` (dealt by source), ``parts`` of the language,
    and ``units`` that its terms are dealt into."""
    per = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / GROUPS).cast("int").alias("parts"))
    out = _salted(groups, per, "source").withColumn("part", F.pmod(F.xxhash64("source"), F.col("parts")).cast("int"))
    return out.withColumn("units", F.greatest(F.ceil(F.col("kept") / TERMS), F.lit(1)).cast("int"))


def _units(of: DataFrame, *cols) -> DataFrame:
    """Rows with a ``part`` copied to each pair of parts that it belongs to."""
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    out = of.select("lang", "unit", "part", other, *cols)
    return out.select("lang", "unit", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", *cols)


def pair_values(entries: DataFrame, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the divergence of each source from each
    other source of its language, over all kept terms.

    ``entries (lang, source, term, n)``: kept terms that a group has; ``terms
    (lang, term, total)``; ``groups (lang, source, total, kept)``."""
    ship(entries.sparkSession)
    groups = _parted(groups).withColumn("size", F.col("total") + F.col("kept"))
    per = groups.groupBy("lang").agg(F.first("parts").alias("parts"), F.first("units").alias("units"))
    unit = F.pmod(F.xxhash64("term"), F.col("units")).cast("int").alias("unit")
    # A term is named in every pair of parts of its unit, a group in every unit.
    both = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    named = _salted(terms, per, "term").select("lang", unit, both.alias("lo"), "parts", "term", "total")
    named = named.select("lang", "unit", "lo", F.explode(F.sequence("lo", F.col("parts") - 1)).alias("hi"), F.lit(None).cast("string").alias("source"), "term", F.col("total").alias("n"))
    part = F.pmod(F.xxhash64("source"), F.col("parts")).cast("int").alias("part")
    found = _units(_salted(entries, per, "term").select("lang", unit, part, "parts", "source", "term", "n"), "source", "term", "n").drop("part")
    every = groups.withColumn("unit", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
    sides = _units(every.select("lang", "unit", "part", "parts", "source", "size"), "source", "size")
    rows = named.unionByName(found)
    # Both come from the same tables: other names keep their keys apart.
    by, its = ["lang", "unit", "lo", "hi"], ["of_lang", "of_unit", "of_lo", "of_hi"]
    sides = sides.select(*[F.col(c).alias(k) for c, k in zip(by, its, strict=True)], "part", "source", "size")
    sums = rows.groupBy(*by).cogroup(sides.groupBy(*its)).applyInArrow(_unit, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _salted(rows: DataFrame, few: DataFrame, by: str, keys: tuple[str, ...] = ("lang",)) -> DataFrame:
    """``rows`` joined with ``few`` on ``keys``, of which one may hold most
    rows: they are dealt into ``SALT`` parts by ``by``, ``few`` is in each."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALT)))
    few = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    return rows.join(few, [*keys, "salt"]).drop("salt")


def term_values(entries: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: of each group's terms that are
    likelier there than in the language the ``top`` most divergent ones."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("in_lang"))
    at = _salted(_salted(entries, groups, "term", ("lang", "source")), langs, "term")
    at = at.select("lang", "source", F.col("term").alias("item"), price("n", "total", "kept").alias("p"), price("in_all", "in_lang", "kept").alias("q"))
    at = at.where("p > q").withColumn("value", F.expr("(p - q) * (p - q) div q")).drop("p", "q")
    # Tasks pass on their own first rows of a group, ``top`` at most.
    at = at.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
    return at.where(F.col("rank") <= top).select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` per group: its divergence from
    each other source of its language (part ``pair``, all of them) and the
    terms that stand out in it (part ``term``, ``top`` at most), ranked by
    value, then by item in code-point order."""
    every = settled(kept_entries(term_counts(docs), min_docs))
    found, entries = every.where("term = ''").select("lang", "source"), every.where("term <> ''")
    terms = settled(entries.groupBy("lang", "term").agg(F.first("in_all").alias("total")))
    n = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    v = terms.select("lang", F.lit(1).alias("k")).union(found.select("lang", F.lit(0)).distinct())
    v = v.groupBy("lang").agg(F.sum("k").alias("kept"))
    groups = found.join(n, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    groups = settled(_salted(groups, v, "source"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_values(entries, terms, groups).withColumn("rank", F.row_number().over(order))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    named = lambda df, part: df.withColumn("part", F.lit(part)).select(*cols)
    return named(pairs, "pair").unionByName(named(term_values(entries, groups, top), "term"))
