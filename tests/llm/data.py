"""Small documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use as names of their own.
CLASHING = (
    "size", "shard", "slot", "n_words", "found", "node", "bucket", "row_key", "selected", "runs", "n_hit",
    "copies", "copy", "n", "key", "bin", "weight", "name", "good", "noise", "count", "component", "class_id",
    "major", "minor", "at", "part", "first", "before", "text_crc32", "_their_0")


def prose(n: int, seed: int, syllables: str = "ba ke lo mi nu ra se ti vo zu") -> str:
    rng = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def documents() -> list[tuple]:
    base = prose(120, 1)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base), (2, base.upper() + "."), (3, near), (4, prose(90, 4)), (5, None), (6, ""),
        (7, " \n\t"), (8, "one two"), (9, "One, two!"), (10, prose(4000, 10)), (10, prose(30, 11)),
        (11, prose(30, 12)), (11, prose(30, 12)), (None, base), (None, prose(20, 13)), (None, None),
        (12, "word " * 50), (13, "é ü ñ " + prose(20, 14)), (14, "\n".join([prose(8, 15)] * 4)),
        (15, "AA!! BB!! " * 20),
    ]
    return [(i, t, "en" if n % 3 else None, f"s{n % 3}" if n % 4 else None, len(t or ""))
            for n, (i, t) in enumerate(rows)]


def frame(spark, rows=None, clashing: bool = True):
    df = spark.createDataFrame(documents() if rows is None else rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        for name in CLASHING:
            df = df.withColumn(name, F.lit("theirs"))
    return df


def folded(text: str | None) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text: str | None, k: int = 5) -> frozenset:
    w = folded(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1))
