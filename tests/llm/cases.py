"""Rows with the awkward cases that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names clash with those that operators make.
CLASHING = ("key", "th", "ids", "words", "score", "start", "anchor", "spans", "n_words", "counts", "base", "runs", "items", "word", "kept", "cluster")

BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions near an old stone bridge at dawn"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in any column, empty and blank texts, a very long text, copies, near copies, shared passages."""
    passage = words(60, 1)
    near = passage.split()
    texts = [
        (1, passage),
        (2, passage),
        (3, " ".join([*near[:-1], "other"])),
        (4, None),
        (5, ""),
        (6, " \t\n\x0b "),
        (7, "one"),
        (8, words(20, 2) + " " + BASE + " " + words(30, 3)),
        (9, BASE + "\n" + BASE.upper() + "\n" + BASE),
        (None, passage),
        (None, None),
        (1, passage),
        (1, words(40, 4)),
        (10, "line one here\nline two here\nline three\n\nline one here\nline two here"),
        (11, "other start\nline one here\nline two here\nline three"),
        (12, words(3000, 5) + " " + passage),
        (13, "été ÉTÉ Straße 漢字 🙂 \u0085 x\xa0y  <|endoftext|> z"),
        (14, "a" * 5000),
        (15, "Under the MIT License.\nApache License, Version 2 and CC-BY-NC; under the mit license"),
        (16, "SPAM!! SPAM!! SPAM!! *** $$$ " * 20),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(spark):
    """The same rows with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    return frame(spark).withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def tuples(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
