from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, first=0):
    """A documents table; an entry is a text or (doc_id, text)."""
    rows = []
    for i, entry in enumerate(texts, first):
        doc_id, text = entry if isinstance(entry, tuple) else (i, entry)
        rows.append((doc_id, text, "en", f"src{i % 3}", len(text or "")))
    return spark.createDataFrame(rows, SCHEMA)


def plain_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


#: Nulls in every column, empty and blank texts, repeated rows, null ids, one very long text.
ODD = [
    (None, None, None, None, None),
    (1, None, "en", "src0", None),
    (2, "", "en", None, 0),
    (3, "  \t\n ", None, "src1", 5),
    (4, "One single line of words, here.", "en", "src1", 31),
    (4, "One single line of words, here.", "en", "src1", 31),
    (None, "One single line of words, here.", "en", "src1", 31),
    (5, "Ünï¢ôdé ☃ " * 3, "fr", "src2", 30),
    (6, words(1, 60_000), "en", "src2", 0),
    (7, "x" * 200_000, "en", "src2", 200_000),
]


def odd_documents(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def clashing(frame, *names):
    """``frame`` with extra columns of the given names."""
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit("mine") for name in names})
