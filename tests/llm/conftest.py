from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, id long, key string, _hash string, _copy string, taken string, size string"


def prose(n: int, step: int = 7) -> str:
    return " ".join(WORDS[(i * step + i * i) % len(WORDS)] + str(i % 13) for i in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "clash", 5, "clash", "clash", "clash", "clash", "clash")


def odd_rows():
    """NULLs, empty and very long texts, ties, repeated rows, columns whose names operators use themselves."""
    return [
        row(1, prose(60)), row(2, prose(60)), row(3, None), row(4, ""), row(5, " \t\n "), row(6, "one two"),
        row(7, "one two"), row(8, prose(30_000, 3)), row(9, "Émile  a  b c   d's it's 12,5%%%"), row(9, "again with the same id"),
        row(10, prose(60).upper(), None, None), row(11, "\x00\x1f odd \U0001F600 signs", "fr", None), row(11, "\x00\x1f odd \U0001F600 signs", "fr", None),
        row(None, "no id here at all", "de", "b"), row(12, "x" * 50_000, "de", "b")]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
