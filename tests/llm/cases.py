"""Small inputs that every operator must cope with, and brute-force forms."""

from __future__ import annotations

import random
import zlib

SF = "/root/testdata/sf0.001"


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def fold(doc_id, parts: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def words(n: int, seed: int, vocabulary: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def messy_rows() -> list[tuple]:
    """(doc_id, text, lang) with nulls, empty and long texts, repeats, ties."""
    long = "\n".join(words(12, s) for s in range(400)) + "\n" + "x" * 20_000
    base = words(80, 1)
    rows = [
        (1, base, "en"),
        (2, base, "en"),
        (2, base, "en"),  # a repeated row
        (3, base + " w1", None),
        (3, words(40, 9), "de"),  # an id with another text
        (None, base, "en"),
        (None, None, None),
        (4, None, "en"),
        (5, "", "de"),
        (6, " \t\r\n\x0b\x0c ", "de"),
        (7, "12 34 !!! \n\n 5", "en"),
        (8, long, "en"),
        (9, "ÄÖÜ É Straße ß   x y \x00 z", "de"),
        (10, "one", "en"),
        (11, "\n\nsame line\nSAME LINE \n  same line\n", "en"),
    ]
    return rows + [(20 + i, f"{words(30, 50 + i)}\nshared line here\n{words(10, i)}", ["en", "de"][i % 2]) for i in range(14)]


def messy(spark):
    """The rows with further columns whose names the operators use inside."""
    rows = [(*r, "src", len(r[1] or ""), 0, "a", "b", 1) for r in messy_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp int, row string, root string, n int").repartition(3)


def empty(spark):
    return messy(spark).limit(0)
