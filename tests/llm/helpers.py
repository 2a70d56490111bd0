"""Tables with everything that operators have to bear, and plain versions of what they compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def documents(spark: SparkSession, texts: dict, **columns) -> DataFrame:
    rows = [(i, t, "en", "src", len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(random.Random(4).choices(["aa", "bb", "cc", "é", "日本"], k=60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 27, 1, 1.0, "x", True),
        (1, "one two three four five six", "en", "a", 27, 1, 1.0, "x", True),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "b", 0, 0, 0.0, "", False),
        (4, " \t\n ", "en", "b", 4, 0, 0.0, "", False),
        (5, long, "en", None, len(long), 9, 9.0, "y", True),
        (6, long, "en", "c", len(long), 9, 9.0, "y", True),
        (None, "lost words", "en", "c", 10, 2, 0.5, "z", False),
        (None, None, "en", "c", 10, 2, 0.5, "z", False),
        (7, "x" * 20_000, "en", "c", 20_000, 2, 0.5, "z", False),
    ]
    schema = SCHEMA + ", n_words int, score double, marks string, copy boolean"
    return spark.createDataFrame(rows, schema)


def random_texts(seed: int, count: int, vocabulary: int = 40, longest: int = 60) -> list[str]:
    """Texts out of few words, with copies, edited copies and shared passages."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(vocabulary)]
    passages = [rng.choices(pool, k=rng.randint(8, 20)) for _ in range(4)]
    texts: list[str] = []
    for _ in range(count):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.35:
            own = words(rng.choice(texts)) or ["w"]
            own[rng.randrange(len(own))] = "edit"
            texts.append(" ".join(own))
        else:
            own = rng.choices(pool, k=rng.randint(0, longest))
            if kind < 0.7:
                own += rng.choice(passages) + rng.choices(pool, k=rng.randint(0, 9))
            texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in own))
    return texts
