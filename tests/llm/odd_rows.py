import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, node string, size string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    words = ["".join(random.Random(1000 + i).choices("abcdefghijklmnopqrstuvwxyz", k=3 + i % 6)) for i in range(vocabulary)]
    return " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."


def row(i, text, lang="en"):
    return (i, text, lang, f"src{(i or 0) % 3}", None if text is None else len(text), 0.25, "k", "n", "s")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, near copies, repeated rows, rows without id."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:-1], "changed."])
    rows = [
        row(1, None), row(2, ""), row(3, "   \n\t "), row(4, "?!... --"), row(5, "Ok"), row(6, "two words"), row(7, base), row(8, base), row(9, near),
        row(10, prose(2, 30_000)), row(11, "x" * 50_000), row(12, prose(3, 5)), row(13, prose(3, 5)), row(13, prose(3, 5)), row(None, base),
        row(None, prose(4, 60)), row(14, None), row(15, "ÄÖÜ ß éèê \U0001f600 é"), row(16, "a a a a a a a a a a a a a a", None), row(17, "12 34 56"),
    ]
    return rows + [row(100 + i, prose(100 + i, 20 + 7 * i), "en" if i % 2 else None) for i in range(12)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
