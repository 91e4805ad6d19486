"""Benchmark decontamination as a prefix-filtered set join, in DataFrame
operations only.

An item's windows (``window`` consecutive words; a shorter item is one window)
are sets of shingles of five words (fewer where the window is shorter). Exact
containment needs all of a window's shingles, so with the shingles ordered by
rarity in the corpus its first one alone is the necessary prefix. Occurrences
of that shingle in documents give the only candidates; position and length
bound where the window can lie, and the words there are compared exactly.

One pass over the texts finds the occurrences of item shingles. A bitmap over
the item shingles' hashes, ``SPARSE`` bits each up to ``2^MOST_BITS`` in all,
drops nearly all positions inside that pass; the rest carry the
words around them and meet the item tables in equi-joins on the shingle, which
adaptive execution splits where a passage is frequent.

Nulls and repeats: a null text has no words. Items without words have no
window; items are told apart by ``item_id`` (repeated ids are one item with
all their windows; a null id is an item that is listed as an empty string).
Rows of ``docs`` equal in id and text are decided alike, one result row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.llm.common import lower_ascii, row_key, settled

#: What separates words: ASCII that is neither a digit nor a letter a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
#: Size of the bitmap in bits, as powers of two: the least, and the most (half a
#: million rows of a long); bits for each shingle in between.
BITS, MOST_BITS, SPARSE = 22, 25, 16


def bitmap_bits(shingles: int) -> int:
    """Size of the bitmap for so many shingles, as a power of two."""
    return min(MOST_BITS, max(BITS, (SPARSE * shingles - 1).bit_length()))


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; none for null."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1)
    return F.array_remove(parts, "")


def _shingle_hashes(word_hashes: str, size: int) -> Column:
    """Hash of the ``size`` words from each position on; null near the end."""
    # A shingle needs all of its words; xxhash64 would skip nulls.
    parts = ", ".join(["x", *[f"get({word_hashes}, i + {k})" for k in range(1, size)]])
    return F.expr(f"transform({word_hashes}, (x, i) -> IF(i + {size} <= size({word_hashes}), xxhash64({parts}), NULL))")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``wid, words, n, size, item_ids`` of the distinct windows; ``size`` is
    the length of their shingles."""
    w = items.select("item_id", words(F.col("text")).alias("ws")).where("size(ws) > 0")
    starts = f"sequence(0, greatest(size(ws) - {window}, 0))"
    w = w.select("item_id", F.explode(F.expr(f"transform({starts}, s -> slice(ws, s + 1, {window}))")).alias("words"))
    w = w.groupBy("words").agg(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("item_ids"))
    return w.select(F.expr("xxhash64(words)").alias("wid"), "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE)).alias("size"), "item_ids")


def _window_shingles(windows: DataFrame) -> DataFrame:
    """``wid, off, size, h`` of every shingle of every window."""
    at = windows.withColumn("wh", F.expr("transform(words, w -> xxhash64(w))"))
    by_size = F.expr("CASE size " + " ".join(f"WHEN {k} THEN s{k} " for k in range(1, SHINGLE + 1)) + "END")
    at = at.select("wid", "size", *[_shingle_hashes("wh", k).alias(f"s{k}") for k in range(1, SHINGLE + 1)])
    return at.select("wid", "size", F.posexplode(by_size).alias("off", "h")).where("h IS NOT NULL")


def _occurrences(docs: DataFrame, shingles: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """``doc rows`` (one per row of ``docs``: doc_id, row, n_words) and the
    positions whose shingle's bit is set: row, n_words, pos, size, h and the
    words around as ``near``."""
    # At most SHINGLE values, whatever the benchmark.
    sized = {r["size"]: r["n"] for r in shingles.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes, bits = sorted(sized), bitmap_bits(sum(sized.values()))
    lanes = shingles.select("size", F.expr(f"shiftrightunsigned(h, {64 - bits})").alias("b"))
    bitmap = lanes.groupBy("size", F.expr("b div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 AS int))")).alias("bits"))
    at = docs.select(F.col("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("row"), words(F.col("text")).alias("ws"))
    at = at.withColumn("wh", F.expr("transform(ws, w -> xxhash64(w))"))
    at = at.select("doc_id", "row", "ws", F.size("ws").alias("n_words"), *[_shingle_hashes("wh", k).alias(f"s{k}") for k in sizes])
    lanes = F.array(*[F.struct(F.lit(k).alias("size"), F.col(f"s{k}").alias("hs")) for k in sizes]) if sizes else F.array(F.struct(F.lit(0).alias("size"), F.array().cast("array<bigint>").alias("hs")))
    at = at.select("doc_id", "row", "ws", "n_words", F.posexplode(lanes).alias("lane", "l"))
    at = at.select("doc_id", "row", "ws", "n_words", "lane", F.col("l.size").alias("size"), F.posexplode_outer("l.hs").alias("pos", "h"))
    at = at.withColumn("word", F.expr(f"shiftrightunsigned(h, {64 - bits}) div 64"))
    at = at.join(F.broadcast(bitmap), ["size", "word"], "left")
    hit = F.expr(f"coalesce((shiftrightunsigned(bits, cast(shiftrightunsigned(h, {64 - bits}) % 64 AS int)) & 1L) = 1L, false)")
    opens = F.expr("lane = 0 AND coalesce(pos, 0) = 0")
    near = F.expr(f"slice(ws, greatest(pos - {window} + 1, 0) + 1, {2 * window - 1})")
    at = at.withColumn("hit", hit).withColumn("opens", opens).where("hit OR opens")
    at = settled(at.select("doc_id", "row", "n_words", "size", "pos", "h", "hit", "opens", F.when(F.col("hit"), near).alias("near")))
    return at.where("opens").select("doc_id", "row", "n_words"), at.where("hit").select("row", "n_words", "size", "pos", "h", "near")


def _prefixes(shingles: DataFrame, found: DataFrame) -> DataFrame:
    """``wid, h, off, size`` of each window's rarest shingle, rarity counted
    over the whole corpus, ties by hash and offset."""
    known = shingles.select("size", "h").distinct()
    often = found.join(known, ["size", "h"], "left_semi").groupBy("size", "h").agg(F.count(F.lit(1)).alias("often"))
    ranked = shingles.join(often, ["size", "h"], "left").withColumn("often", F.coalesce("often", F.lit(0)))
    least = ranked.groupBy("wid", "size").agg(F.min(F.struct("often", "h", "off")).alias("p"))
    return least.where("p.often > 0").select("wid", "size", F.col("p.h").alias("h"), F.col("p.off").alias("off"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, row, n_words, n_hit, item_ids`` per row of ``docs``: the
    number of words inside any occurrence of an item window, and the sorted
    ids (as strings) of the items whose windows occur."""
    windows = settled(item_windows(items, window))
    shingles = settled(_window_shingles(windows))
    rows, found = _occurrences(docs, shingles, window)
    prefix = _prefixes(shingles, found).join(windows.select("wid", "n", "words"), "wid")
    # Candidates: the window would start where its prefix shingle puts it.
    cand = found.join(prefix, ["size", "h"]).withColumn("start", F.col("pos") - F.col("off"))
    cand = cand.where("start >= 0 AND start + n <= n_words")
    there = F.expr(f"slice(near, start - greatest(pos - {window} + 1, 0) + 1, n)")
    hits = settled(cand.where(there == F.col("words")).select("row", "wid", "start", "n"))
    spans = hits.groupBy("row", "start").agg(F.max("n").alias("n"))
    # Words up to the furthest end so far are counted already.
    so_far = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("end", F.col("start") + F.col("n")).withColumn("until", F.coalesce(F.max("end").over(so_far), F.lit(0)))
    n_hit = spans.groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "until"), F.lit(0))).cast("long").alias("n_hit"))
    ids = hits.select("row", "wid").distinct().join(windows.select("wid", "item_ids"), "wid")
    ids = ids.select("row", F.explode("item_ids").alias("item_id")).distinct()
    ids = ids.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    out = rows.join(n_hit.join(ids, "row"), "row", "left")
    return out.select(
        "doc_id",
        "row",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit in ``found`` (of ``contamination``)."""
    bad = found.where("n_hit > 0").select(F.col("row").alias("__row"))
    return docs.withColumn("__row", row_key(F.col("doc_id"), F.col("text"))).join(bad, "__row", "left_anti").select(*docs.columns)
