"""Small tables with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (1, None, "en", "s", None),
    (2, "", "en", "s", 0),
    (3, " \t\n\x0b\x0c\r ", None, None, 7),
    (4, "one two three", "en", "s", 13),
    (4, "one two three", "en", "s", 13),
    (4, "another text under the same id, as long as it takes to be one", "en", "s", 60),
    (None, "a row without an id but with words enough for shingles", "en", "s", 50),
    (5, "ONE two\nthree", "en", "s", 13),
    (6, "Straße ÉCOLE ñandú 東京 😀 <|endoftext|> don't #1", "de", "s", 40),
    (7, "word " * 20_000, "en", "s", 100_000),
    (8, "x" * 50_000, "en", "s", 50_000),
    (9, "same line here with words\nsame line here with words\nother", "en", "s", 60),
]


def table(spark, rows=ODD, clash=False):
    docs = spark.createDataFrame(rows, DOCS)
    if clash:  # columns with names that operators give as well
        for name in ("kept", "score", "slot", "shard", "ids", "decoded", "qr_kept", "n_dropped", "key", "node", "h", "pos"):
            docs = docs.withColumn(name, docs["lang"])
    return docs


def fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


def shingles(text) -> set:
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def linked(sets: list[set], percent: int = 75) -> list[int]:
    """Component of each set, as the position of its first member."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    having = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    common = Counter((a, b) for found in having.values() for k, b in enumerate(found) for a in found[:k])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]
