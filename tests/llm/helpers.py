"""Fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import random
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def lower(text: str) -> str:
    return text.encode().lower().decode()


def fold(doc_id, n: int = 5) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def frame(spark, rows, extra: bool = False, parts: int = 3):
    """documents from (doc_id, text); with ``extra``, more columns whose names
    clash with those the operators use inside."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(rows, DOCS).repartition(parts)
    if extra:
        from pyspark.sql import functions as F

        for c in ("id", "row", "key", "node", "anchor", "block", "stats", "score", "rest", "spans", "kept",
                  "length", "rank", "n_tokens", "fold", "item", "k1", "pos", "line", "_part", "n"):
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def sentences(seed: int, n: int, vocabulary: int = 60, most: int = 60) -> list[str]:
    """Random texts, some of them copies and near copies of earlier ones, with
    blank space of all kinds."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["The", "ÉTÉ", "naïve,", "x.", " y", "日本"]
    texts: list[str] = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.4:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            texts.append(" ".join(own))
        else:
            size = rng.choice([0, 1, 2, 3, 12, 13, 14, rng.randint(0, most)])
            gaps = [rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(size)]
            texts.append("".join(rng.choice(vocab) + g for g in gaps))
    return texts


#: Nulls in any column, empty and blank texts, ties, repeated rows, rows that share an id.
ODD = [
    (None, "a text without an id that is long enough to have a window of thirteen words in it"),
    (None, None), (3, None), (4, ""), (5, " \n\t "), (6, "one"),
    (7, "the same row twice, of the kind that tables have when they were loaded twice by mistake"),
    (7, "the same row twice, of the kind that tables have when they were loaded twice by mistake"),
    (8, "one id, first text"), (8, "one id, second text"),
    (9, "a text without an id that is long enough to have a window of thirteen words in it"),
    (-1, "tied tied tied tied tied tied tied tied tied tied tied tied tied tied tied"),
    (2**40, "tied tied tied tied tied tied tied tied tied tied tied tied tied tied tied"),
]
LONG = (10, "a very long text of one line " * 20_000 + "x" * 50_000)
