"""Small document tables for the training-data operators, and words as the contracts define them."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

#: Columns named like those the operators make or use on the way.
CLASHING = ["score", "n", "id", "sig", "component", "rank", "label", "place", "count", "seed", "holder", "pattern", "mark", "cut", "mix_position", "bits", "row", "key", "line"]


def rows(spark, texts: list, start: int = 0):
    """A documents table of texts, or of (doc_id, text) pairs."""
    data = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (start + i, t)
        data.append((doc, text, ("en", "de")[i % 2], f"s{i % 3}", len(text) if text is not None else None))
    return spark.createDataFrame(data, DOCUMENTS)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def awkward() -> list:
    """Null, empty, blank, short, very long, repeated and tied rows, and rows without an id."""
    same = prose(1, 80)
    return [None, "", " \t\n", "one", "two words", same, same, edited(same, 2, 1), (None, same), (None, None), prose(3, 60_000), "x" * 70_000, (5, same), (5, "another text of the same id here"), "line a\n\nline b", "ÄÖÜ ß é"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING])
