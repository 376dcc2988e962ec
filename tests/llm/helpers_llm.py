"""Small tables with missing values, repeated rows and columns whose names clash."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, _row long, _text string, n int, size string, comp int"


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "s", 1, "x", 2, "y", 3) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def words(text):
    return WORD.findall(text or "")
