"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def odd_texts(rng: random.Random) -> list[str | None]:
    """Null, empty, white space, one word, ties, repeated rows, non-ASCII and a very long text."""
    long_ = " ".join(words(rng, 30_000))
    return [None, "", " ", "\n\n \t", "word", "a b c d", "Ünïcödé déjà vu ß ﬁ", "日本語 の テキスト です", "x" * 5000, "a " * 400, "A b\x0bC\x0cd\re\x1ff g h", "🙂 emoji 🙂🙂 text", long_, "same text here now again", "same text here now again"]


def table(spark, texts, sources=None, start=0, schema=SCHEMA):
    rows = [(start + i, t, "en", sources[i] if sources else f"host{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def by_id(df, key="doc_id") -> pd.DataFrame:
    out = df.toPandas()
    return out.sort_values(key).reset_index(drop=True)
