"""Small tables with nulls, empty and long texts, repeated rows and columns of clashing names."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, label string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(n, seed=0):
    return " ".join(WORDS[(i * i + 3 * i * seed + seed) % len(WORDS)] + str((i * 7 + seed) % 50) for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, sentence(40 + i, i), "en", f"s{i % 3}") for i in range(30)]
    rows += [(100, None, None, None), (101, "", "en", "s0"), (102, "   \n ", "en", "s0"), (103, "!!! ---", "en", "s1"), (104, sentence(5000, 3), "en", "s1"), (105, "one", None, "s2"), (None, sentence(50, 77), "en", None)]
    rows += [(106, sentence(60, 5), "en", "s0"), (107, sentence(60, 5), "fr", None), (5, sentence(45, 5), "en", "s2"), (5, sentence(45, 5), "en", "s2")]
    rows += [(108, "it's  Ünïcode\tжdж x² y <|endoftext|>", "en", "s0")]
    return [(i, t, lang, s, len(t or ""), 0.5, 7, "x") for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
