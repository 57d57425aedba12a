"""Small documents with every kind of trouble."""

from __future__ import annotations

import random

from pyspark.sql import types as T

from marketbars.llm.shared import importable

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        T.StructField("id", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("text_id", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("cluster", T.StringType()),
    ]
)


def prose(seed: int, words: int, stock: int = 400) -> str:
    rng = random.Random(seed)
    letters = "aeioulnrst"
    pool = random.Random(1)
    vocabulary = ["".join(pool.choices(letters, k=pool.randint(2, 8))) for _ in range(stock)]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


def documents(spark, texts, lang="en", source="s"):
    """Rows of (doc_id, text) with columns of clashing names."""
    importable(spark)
    rows = [
        (i, t, lang, source, None if t is None else len(t), "x", "y", "z", "s", "t", "k", "c")
        for i, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


def edit(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def trouble() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, odd characters, ties and repeated rows."""
    base = prose(3, 150)
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, edit(base, 1, 2)),
        (4, edit(base, 2, 1)),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "one"),
        (9, "One  two"),
        (9, "something else"),
        (None, prose(4, 90)),
        (None, None),
        (10, "ééß 漢字 😀  x\u0085y \0 z'll <|endoftext|> 1234"),
        (11, "go " * 900),
        (12, prose(5, 6000)),
        (13, prose(6, 120) + "\n" + base[:700]),
        (14, prose(7, 60) + " " + base[200:800] + " " + prose(8, 40)),
        (15, "### $$$ %%%"),
        (-3, prose(9, 30)),
    ]
