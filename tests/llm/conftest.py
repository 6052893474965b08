import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import CLASH, DOCS, SF  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, ties, repeated rows; clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"), (2, None, "en", "a"), (3, "", None, "b"),
            (4, " \t\n ", "de", None), (5, long, "en", "b"), (6, long + " tail", None, "c"), (7, "one two", "fr", "a"),
            (8, "one  two", "fr", "a"), (9, "one two", "fr", "a"), (9, "one two", "fr", "a"), (None, "one two", "fr", "a"),
            (None, None, None, None), (10, "né à l'été 2020 écrire à a.b@c.de, 10.0.0.1", "fr", "d"), (11, "12345 67890", None, "d"),
            (12, "Alpha beta gamma delta epsilon zeta eta theta iota KAPPA", "en", "e")]
    extra = tuple("x" for _ in CLASH.split(","))
    return spark.createDataFrame([(*r, len(r[1] or "")) + extra for r in rows], f"{DOCS}, {CLASH}")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
