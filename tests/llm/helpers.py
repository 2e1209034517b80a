"""Small tables for the training-data operators, with the edge cases they define."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(rnd: random.Random, n: int, stems=("lo", "ra", "mi", "ten", "sol", "var", "ki", "un", "do", "pre")) -> str:
    return " ".join("".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def frame(spark, texts, first=0):
    """Documents with the given texts; extra columns that clash with helper names."""
    rows = [(i + first, t, "en", "s", len(t or ""), f"r{i}", i, None, {"a": i}) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", row string, k int, _ string, m map<string,int>")


def empty(spark):
    return spark.createDataFrame([], DOCS)
