import random

import pytest


def prose(seed, n, lang="en"):
    """``n`` invented words of one of two languages."""
    rng = random.Random(seed)
    parts = {"en": ("th", "er", "ing", "on", "wh", "st", "ly", "ed"), "de": ("sch", "ung", "ein", "ge", "ü", "keit", "ver", "tz")}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and white-space texts, a very long one, ties and repeats."""
    long = prose(1, 60_000)
    return [None, "", " ", "\n", "\t \x0b\x0c\r", "a", "A  b\n\n c ", "▁x 漢字😀 ½", "x" * 3000, long, prose(2, 50), prose(2, 50), "Line\nline \n LINE", "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Documents with repeated and null ids, null labels, and columns that clash with the operators' own names."""
    rows = [(i, t, "en" if i % 2 else None, None, 0, "x", 1.5, i) for i, t in enumerate(odd_texts)]
    rows += [rows[5], (None, "null id", None, None, None, None, None, None), (None, "null id", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, score double, fp long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
