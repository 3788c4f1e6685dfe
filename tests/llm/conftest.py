import random

import pytest

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def edited(tokens, share, seed):
    draw = random.Random(seed)
    return [f"x{draw.randrange(999)}" if draw.random() < share else t for t in tokens]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(words(9_000, 1))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
        (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \t\n ", "en", "b", 4),
        (None, "no id at all", "en", "b", 12), (5, long, "en", "a", len(long)),
        (6, long, "en", "a", len(long)), (7, "ÀÉ ß 日本 😀 \x00 ▁ x", "xx", "b", 16),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    extra = {name: docs.source for name in (
        "component_id", "fp", "score", "blob", "path", "node", "chunk", "word", "part", "bands",
    )}
    return docs.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
