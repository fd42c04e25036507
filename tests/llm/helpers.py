"""Small tables for the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside, and results carry: they may not meet the tables' own.
CLASHING = ["_row", "_text", "hash", "size", "fp", "_size", "grp", "x", "copies", "base", "spans", "_hash", "_id"]


def documents(spark, rows, clashing=True):
    """`rows`: (doc_id, text, lang, source). With columns of clashing names."""
    frame = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOCS)
    if clashing:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"cast(doc_id as string) as `{name}`")
    return frame


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('bcdfglmnprst')}{draw.choice('aeiou')}{draw.randrange(vocabulary)}" for _ in range(words))


def odd_rows():
    """Nulls, empty texts, ties, repeated rows and a long text."""
    long = prose(99, 30_000)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, None),
        (None, prose(1, 80), "en", None),
        (None, None, None, None),
        (4, prose(2, 120), "en", "a"),
        (4, prose(2, 120), "en", "a"),
        (5, prose(2, 120), "en", "b"),
        (4, prose(3, 70), "de", "a"),
        (6, long, "en", "a"),
        (7, "one", "en", "b"),
    ]
