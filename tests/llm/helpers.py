"""Small tables with the cases every operator has to define: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import random

AWKWARD = [
    (1, None),
    (2, ""),
    (None, "only text without an id"),
    (3, " \n\t "),
    (4, "same text same text same text same text"),
    (4, "same text same text same text same text"),
    (5, "same text same text same text same text"),
    (6, "é中文 😀 ſ İ \x00 <|endoftext|> 's"),
    (7, "word " * 30_000),
    (8, "x" * 100_000),
    (9, "1 " * 20_000),
]


def documents(spark, rows=AWKWARD, source="s", lang=None):
    """doc_id, text and columns whose names the operators use inside or put out."""
    full = [(i, t, lang or "en", source, "kept", 1.5, [1]) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, spans string, score double, ids array<int>"
    return spark.createDataFrame(full, schema)


def mixed_texts(tokens: list[str], n: int, most: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(tokens) for _ in range(rng.randint(0, most))) for _ in range(n)]
