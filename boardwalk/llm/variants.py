"""Spelling variants: words that differ by one code point, grouped by form.

``corpus_words`` counts the words of a corpus. ``near_words`` finds all pairs
of words that differ by exactly one inserted, deleted or replaced code point,
through an index of variable-length grams:

* Dictionary. Grams of two and three code points are counted over the words. A
  gram of two that few words hold is selective as it is; one that more than
  ``prune`` of the words hold gives way to the grams of three that extend it.
  The dictionary has ``DICTIONARY`` grams at most; any dictionary is right, a
  better one makes shorter lists.
* Decomposition. At each position of a word but the last stands its longest
  dictionary gram, or the gram of two there.
* Affected grams. One edit at i changes the grams at i and i - 1, and that at
  i - 2 if its first two code points begin a dictionary gram. So each word has
  a bound of its own, 2 or 3, on the grams that an edit may touch; all others
  stand in the other word at the same distance from the start (those before
  the edit) or from the end (those after it).
* Lists. A word is posted under its rarest grams, one more than its bound: two
  near words have an untouched gram among those of each. A list's key is the
  gram, its distance from the start or from the end, and the length of the
  longer word. Lists are merged by counting, for the words that meet, the
  grams they share at those distances; pairs that reach the larger of both
  words' bounds (grams less affected ones) are verified. Words never leave as
  pairs of a list, only as verified pairs.

A list longer than ``block`` words is dealt into blocks by hash, and each pair
of blocks is a unit of its own; the work on such a list grows with the square
of its blocks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, settled, smallest, split_words

#: Grams that are kept with their counts.
DICTIONARY = 1 << 16
#: Words of this length have an untouched gram whatever the edit.
SHORTEST = 5
#: Distinct words a task counts before it passes them on; elements of a matrix.
COUNTED, CELLS = 1 << 17, 1 << 22

# Letters A-Z, a-z and U+00C0 to U+00FF, as Latin-1 bytes; capitals A-Z fold.
_RUNS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
_BITS = 21


def _doc_words(doc_id: int | None, text: str, drop_every: int | None, min_chars: int, counts: Counter) -> None:
    """Adds the words of one document to ``counts``, as Latin-1 bytes."""
    runs: Counter = Counter()
    for words in split_words(text.encode("latin-1", "replace").translate(_RUNS)):
        runs.update(words)
    if drop_every is None:
        for run, n in runs.items():
            if len(run) >= min_chars:
                counts[run] += n
        return
    start = zlib.crc32(b"%s:" % ("" if doc_id is None else str(doc_id)).encode())
    for run, n in runs.items():
        if len(run) < min_chars:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % drop_every == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
            if len(run) < min_chars:
                continue
        counts[run] += n


def corpus_words(docs: DataFrame, min_chars: int = 6, min_count: int = 5, drop_every: int | None = None) -> DataFrame:
    """``word, n``: distinct words of at least ``min_chars`` code points and
    ``min_count`` occurrences in the whole texts. Words are the maximal runs of
    A-Z, a-z and U+00C0 to U+00FF with only A-Z in lower case.

    With ``drop_every``, a run of a document loses one code point where the
    crc32 h of ``<doc_id>:<run>`` is divisible by it: that at h % length. A
    null id counts as ''. A null text has no words; repeated rows count each;
    no rows: no words. Only ``doc_id`` and ``text`` are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def part() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if text.is_valid:
                    _doc_words(doc_id, text.as_py(), drop_every, min_chars, counts)
                if len(counts) >= COUNTED:
                    yield part()
                    counts.clear()
        yield part()

    rows = arrow_rows(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- grams --------------------------------------------------------------------------
def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of words, a word per row, zeros behind."""
    out = np.zeros((len(words), width), np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    out[np.arange(width) < size[:, None]] = flat
    return out


def _twos_threes(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of two and of three at each position, 0 where the word ends before."""
    two = np.where(m[:, 1:] > 0, (m[:, :-1] << _BITS) | m[:, 1:], 0)
    three = np.zeros_like(two)
    three[:, :-1] = np.where(m[:, 2:] > 0, (two[:, :-1] << _BITS) | m[:, 2:], 0)
    return two, three


class Grams:
    """The dictionary and the frequencies by which grams are ordered."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, common: int):
        by = np.argsort(grams)
        self.grams, self.counts = grams[by], counts[by]
        twos = self.grams[(self.grams < 1 << 2 * _BITS) & (self.counts > common)]
        threes = self.grams[self.grams >= 1 << 2 * _BITS]
        self.threes = threes[np.isin(threes >> _BITS, twos)]
        self.begin = np.unique(self.threes >> _BITS)

    @staticmethod
    def _in(x: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(x.shape, bool)
        return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x

    def decompose(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words as code points: the gram at each position (0: none), and
        how many grams one edit may touch."""
        two, three = _twos_threes(m)
        begins = self._in(two, self.begin)
        gram = np.where(begins & self._in(three, self.threes), three, two)
        size = (m > 0).sum(axis=1)
        inner = np.arange(two.shape[1]) <= size[:, None] - 4
        return gram, 2 + (begins & inner).any(axis=1)

    def rarest(self, gram: np.ndarray, n: int) -> np.ndarray:
        """Positions of each row's ``n`` rarest grams, by frequency, gram and
        position; -1 beyond the last."""
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        often = np.where(self.grams[at] == gram, self.counts[at], 0) if len(self.grams) else np.zeros(gram.shape, np.int64)
        often = np.where(gram > 0, often, np.iinfo(np.int64).max)
        pos = np.broadcast_to(np.arange(gram.shape[1]), gram.shape)
        order = np.lexsort((pos, gram, often))[:, :n]
        return np.where(np.take_along_axis(gram, order, axis=1) > 0, order, -1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, int]]:
    """Which words have each length, in parts of bounded matrices."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size):
        which = np.flatnonzero(size == length)
        step = max(1, CELLS // int(length))
        for k in range(0, len(which), step):
            yield which[k : k + step], int(length)


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram, n``: occurrences of each gram of two or three code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            found = [np.empty(0, np.int64)]
            for which, length in _by_length(texts):
                found += [g[g > 0] for g in _twos_threes(_codes([texts[i] for i in which], length))]
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])

    return arrow_rows(words.select("word"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_index(words: DataFrame, prune: float = 0.02) -> Grams:
    """The dictionary of ``words``: its ``DICTIONARY`` most frequent grams reach
    the driver, no more."""
    total = words.count()
    top = smallest(gram_counts(words), DICTIONARY, F.col("n").desc(), "gram")
    return Grams(np.array([r.gram for r in top], np.int64), np.array([r.n for r in top], np.int64), int(total * prune))


# -- lists --------------------------------------------------------------------------
_POSTED = "size int, side int, gram long, pos int, word string, n long"


def _post(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = index.value
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            for which, length in _by_length(words):
                gram, touched = grams.decompose(_codes([words[i] for i in which], length))
                at = grams.rarest(gram, 4)
                at[np.arange(4) > touched[:, None]] = -1
                row, col = np.nonzero(at >= 0)
                pos = at[row, col]
                own = which[row]
                for size in (length, length + 1):  # of the longer word of a pair
                    for side, far in ((0, pos), (1, length - pos)):
                        cols = [np.full(len(row), size, np.int32), np.full(len(row), side, np.int32), gram[row, pos], far.astype(np.int32)]
                        arrays = [*map(pa.array, cols), b.column(0).take(pa.array(own)), pa.array(n[own])]
                        yield pa.RecordBatch.from_arrays(arrays, ["size", "side", "gram", "pos", "word", "n"])

    return run


def _merge(index):
    """mapInArrow over rows of units (``_POSTED``, ``lo``, ``hi``, ``own``),
    sorted by unit, longer words of a unit first."""

    def pairs(grams: Grams, size: int, words: list[str], n: np.ndarray, unit: np.ndarray, side: np.ndarray, across: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole units whose longer words have ``size`` code points."""
        m = _codes(words, size)
        gram, touched = grams.decompose(m)
        long = m[:, -1] > 0
        sure = np.where(long, size, size - 1) - 1 - touched
        # A long word meets those behind it in its unit: all of them at the
        # same distance from the start, only shorter ones from the end.
        at = np.arange(len(words))
        end = np.searchsorted(unit, unit, side="right")
        shorts = np.concatenate(([0], np.cumsum(~long)))
        first_short = end - (shorts[end] - shorts[np.searchsorted(unit, unit)])
        begin = np.where(side == 0, at + 1, first_short)
        meets = np.where(long, np.maximum(end - begin, 0), 0)
        upto = np.cumsum(meets)
        total, step = int(upto[-1]), max(1, CELLS // size)
        for k in range(0, total, step):
            flat = np.arange(k, min(k + step, total))
            a = np.searchsorted(upto, flat, side="right")
            b = begin[a] + flat - (upto[a] - meets[a])
            ok = ~across[a] | (own[a] != own[b])
            a, b = a[ok], b[ok]
            ga, gb, same = gram[a], gram[b], long[b]
            shared = ((ga == gb) & (ga > 0)).sum(axis=1)
            shared += np.where(same, 0, ((ga[:, 1:] == gb[:, :-1]) & (gb[:, :-1] > 0)).sum(axis=1))
            ok = shared >= np.maximum(sure[a], sure[b])
            a, b, same = a[ok], b[ok], same[ok]
            ma, mb = m[a], m[b]
            equal = ma == mb
            before = np.cumprod(equal, axis=1).sum(axis=1)
            after = np.cumprod((ma[:, 1:] == mb[:, :-1])[:, ::-1], axis=1).sum(axis=1)
            ok = np.where(same, equal.sum(axis=1) == size - 1, before + after >= size - 1)
            a, b = a[ok], b[ok]
            if len(a):
                found = [pa.array([words[i] for i in a], pa.string()), pa.array([words[i] for i in b], pa.string()), pa.array(n[a]), pa.array(n[b])]
                yield pa.RecordBatch.from_arrays(found, ["a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = index.value, None

        def whole(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            keys = np.stack([t.column(c).to_numpy() for c in ("size", "side", "gram", "pos", "lo", "hi")])
            new = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            cut = t.num_rows if last else int(np.flatnonzero(new)[-1])
            held = t.slice(cut)
            unit = np.cumsum(new)[:cut]
            keys = keys[:, :cut]
            met = np.bincount(unit)[unit] > 1  # lists of one hold no pair
            for size in np.unique(keys[0][met]):
                w = np.flatnonzero(met & (keys[0] == size))
                some = t.take(pa.array(w))
                yield from pairs(grams, int(size), some.column("word").to_pylist(), some.column("n").to_numpy(), unit[w], keys[1][w], (keys[4] != keys[5])[w], some.column("own").to_numpy())

        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                yield from whole(pa.concat_tables([held, t]) if held is not None else t, last=False)
        if held is not None and held.num_rows:
            yield from whole(held, last=True)

    return run


def near_words(words: DataFrame, prune: float = 0.02, block: int = 4096) -> DataFrame:
    """``a, b, na, nb``: each pair of ``words (word, n)`` that differ by exactly
    one inserted, deleted or replaced code point, once, with both counts.

    ``words`` must be distinct, each of ``SHORTEST`` code points or more. A
    word's list entries grow with neither its length nor the corpus."""
    spark = words.sparkSession
    index = spark.sparkContext.broadcast(gram_index(words, prune))
    posted = arrow_rows(words.select("word", "n"), _post(index), _POSTED)
    key = ["size", "side", "gram", "pos"]
    # No more of these than postings by block; the counts combine before the shuffle.
    hot = posted.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > block)
    hot = hot.select(*key, F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    met = posted.join(hot, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    cells = met.select(*key, "word", "n", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select(*key, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "word", "n")
    by = [*key, "lo", "hi"]
    units = cells.repartition(*by).sortWithinPartitions(*by, F.char_length("word").desc())
    found = arrow_rows(units, _merge(index), "a string, b string, na long, nb long")
    # Two words meet in every list that posts both.
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of each row of ``forms (word, form)``: where following
    forms ends. Every round doubles the steps taken; a form's count is at least
    ``ratio`` times its word's, so there are few."""
    at = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = settled(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        at = step.select("word", "root")
        if step.where("went").isEmpty():
            return at


def variant_groups(words: DataFrame, ratio: int = 5, prune: float = 0.02, block: int = 4096) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` per row of ``words (word, n)``.

    ``n_near``: how many words differ by one code point. ``form``: of those the
    one of largest n (ties: smallest in code-point order) if that n is at least
    ``ratio`` times the word's, else null; ``form_n`` its n. ``root``: where
    following forms from the word ends, the word itself if it has none. With a
    ratio of 2 or more no form leads back. No words: no rows."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = settled(words.select("word", "n"))
    near = settled(near_words(words, prune, block))
    both = near.select("a", "b", "nb").union(near.select("b", "a", "na")).toDF("word", "near", "near_n")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= F.col("n") * ratio
    out = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    out = settled(out)
    roots = _roots(out.where(F.col("form").isNotNull()))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, drop_every: int | None = None) -> DataFrame:
    """``variant_groups`` of ``corpus_words``."""
    if min_chars < SHORTEST:
        raise ValueError(f"min_chars must be {SHORTEST} or more")
    return variant_groups(corpus_words(docs, min_chars, min_count, drop_every), ratio)
