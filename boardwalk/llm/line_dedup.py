"""Removal of lines that recur across documents, in DataFrame operations only.

``line_bitmaps`` decides and returns one compressed bitmap per document;
``drop_lines`` carries the decision out on the texts.

The keys' hashes are range-partitioned with document and position as secondary
sort, so a task streams through each key's occurrences in order: the first row
of a key is its first occurrence, the first row of a document in a key counts
that document. All rows of a key meet for that, so the keys frequent enough to
unbalance a range (at most ``HOT_KEYS``, found by a frequent-items sketch) are
taken out before and counted exactly by aggregations that combine before their
shuffle. The sketch only chooses which of the two exact ways a key takes.

Nulls and repeats: a null text is one empty line; an empty key never counts.
A null ``doc_id`` is a document like any other. Rows equal in id and text have
equal lines, hence one decision, and each counts as a document. No rows: no
rows. Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.llm.common import BLANKS, lower_ascii, row_key, settled

#: At most so many keys hold more than one in HOT_KEYS of all lines each; the
#: sketch tracks enough items to report every one of them. Tasks' sketches are
#: merged in so many groups first.
HOT_KEYS, TRACKED, GROUPS = 1024, 65536, 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``row, lines``: 96 bits for each line's key, null where the key has
    fewer than ``min_chars`` code points."""
    keys = F.transform(_lines(lower_ascii(F.col("text"))), lambda x: F.trim(x, F.lit(BLANKS)))
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), keys.alias("keys"))
    key = lambda k: F.struct(F.xxhash64(k).alias("h"), F.hash(k).alias("g"))
    return rows.select("row", F.transform("keys", lambda k: F.when(F.char_length(k) >= min_chars, key(k))).alias("lines"))


def _hot(at: DataFrame) -> DataFrame:
    """``h`` of the keys that hold more than one in HOT_KEYS of all lines."""
    some = at.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part"))
    some = some.agg(F.expr(f"approx_top_k_accumulate(h, {TRACKED})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    # Grouped, if by nothing: there is no sketch of no rows.
    top = some.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("n").alias("n"))
    top = top.select("n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {HOT_KEYS})")).alias("t"))
    return top.where(F.col("t.count") > F.col("n") / HOT_KEYS).select(F.col("t.item").alias("h")).distinct()


def _cold_drops(at: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    ordered = at.repartitionByRange("h", "g").sortWithinPartitions("h", "g", "row", "pos")
    key, doc = Window.partitionBy("h", "g"), Window.partitionBy("h", "g", "row").orderBy("pos")
    # Ties are copies of a row: each is a document of its own.
    seen = ordered.withColumn("opens", F.rank().over(doc) == 1)
    seen = seen.withColumn("first", F.rank().over(key.orderBy("row", "pos")) == 1)
    seen = seen.withColumn("n_docs", F.sum(F.col("opens").cast("long")).over(key)).where(F.col("n_docs") >= min_docs)
    return seen.where(~F.col("first") if keep_first else F.lit(True)).select("row", "pos")


def _hot_drops(at: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    per_line = at.groupBy("h", "g", "row", "pos").agg(F.count(F.lit(1)).alias("copies"))
    per_doc = per_line.groupBy("h", "g", "row").agg(F.min_by("copies", "pos").alias("copies"), F.min("pos").alias("pos"))
    keys = per_doc.groupBy("h", "g").agg(F.sum("copies").alias("n_docs"), F.min(F.struct("row", "pos")).alias("first"))
    keys = keys.where(F.col("n_docs") >= min_docs).select("h", "g", "first")
    # No more rows than _hot() reports, whatever the input.
    out = at.join(F.broadcast(keys), ["h", "g"])
    return out.where(F.struct("row", "pos") != F.col("first") if keep_first else F.lit(True)).select("row", "pos")


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``row, keep`` for each document that loses lines.

    ``keep`` is an array of longs: bit ``i % 64`` of word ``i div 64`` is set
    if line ``i`` stays. Words after the last lost line are left out, as are
    documents that keep every line.

    Lines go whose key occurs in ``min_docs`` documents or more: all of them
    or, with ``keep_first``, all but the first by (row, position).
    """
    hashes = settled(line_hashes(docs, min_chars))
    at = hashes.select("row", F.posexplode("lines").alias("pos", "k")).where("k IS NOT NULL").select("k.h", "k.g", "row", "pos")
    hot = settled(_hot(at))
    drops = _cold_drops(at.join(F.broadcast(hot), "h", "left_anti"), min_docs, keep_first)
    drops = drops.union(_hot_drops(at.join(F.broadcast(hot), "h"), min_docs, keep_first))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = drops.groupBy("row", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("lost"))
    docs_words = words.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("word", "lost"))).alias("w"))
    # Words without a lost line are filled in between those with one.
    before = "IF(i = 0, -1, w[i - 1].word)"
    keep = F.expr(f"flatten(transform(w, (x, i) -> concat(array_repeat(-1L, x.word - {before} - 1), array(~x.lost))))")
    return docs_words.select("row", keep.alias("keep"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``__kept`` (the remaining lines joined by a line feed, ''
    for a null text), ``__n_lines`` (before) and ``__n_dropped``."""
    marks = bitmaps.select(F.col("row").alias("__row"), F.col("keep").alias("__keep"))
    at = docs.withColumn("__row", row_key(F.col("doc_id"), F.col("text"))).join(marks, "__row", "left")
    at = at.withColumn("__lines", _lines(F.col("text")))
    stays = "i >= 64 * size(__keep) OR (shiftright(__keep[i div 64], i % 64) & 1L) = 1L"
    kept = F.when(F.col("__keep").isNull(), F.col("__lines")).otherwise(F.expr(f"filter(__lines, (x, i) -> {stays})"))
    at = at.withColumn("__left", kept)
    return at.select(
        *[F.col(c) for c in docs.columns],
        F.array_join("__left", "\n").alias("__kept"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size("__left")).cast("long").alias("__n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``docs`` with its recurring lines gone from ``text``; ``n_chars``, if
    there, follows. Every row stays; a null text stays null."""
    out = drop_lines(docs, line_bitmaps(docs, min_docs, min_chars, keep_first))
    new = F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col("text"))
    out = out.withColumn("__new", new)
    cols = [F.col("__new").alias(c) if c == "text" else F.coalesce(F.when(F.col("__n_dropped") > 0, F.char_length("__new").cast("long")), F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)
