"""Small documents with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    T.StructField("score", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("node", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("stats_", T.StringType()),
])


def words(seed: int, n: int, size: int = 400) -> list[str]:
    draw = random.Random(seed)
    known = ["".join(draw.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(draw.randint(1, 4)))
             for _ in range(size)]
    return [draw.choice(known) for _ in range(n)]


def rows(texts: list[tuple]) -> list[tuple]:
    return [(i, t, "en", "s", None if t is None else len(t), "x", 7, "y", "z", "w") for i, t in texts]


def frame(spark, texts: list[tuple]):
    return spark.createDataFrame(rows(texts), DOCS).repartition(3)


def awkward() -> list[tuple]:
    """(id, text): nulls, empties, ties, repeated rows, a very long text."""
    base = words(1, 300)
    near = base.copy()
    near[150] = "changed"
    long = " ".join(words(2, 60_000))
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (4, None), (5, ""), (6, "   \n\t "),
        (7, "one two"), (8, "One two"), (9, "É one"), (10, "é one"), (11, long), (12, long + " tail"),
        (13, "token = abcdef1234"), (13, "token = abcdef1234"), (14, "token = abcdef1234"), (None, "token = abcdef1234"),
        (None, "no id at all"), (15, "a▁b  c\n\n d 🙂 \x00"), (16, "word " * 3000), (17, " ".join(words(3, 40))),
    ]
