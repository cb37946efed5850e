import os
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key string, n long, kept string, sig long"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeats and clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    prose = " ".join(f"word{i}" for i in range(120))
    rows = [
        (0, prose, "a"), (1, prose.upper(), "a"), (2, prose + " more", "b"), (3, None, "a"), (4, "", "b"), (5, " \t\n", None),
        (6, "one", "c"), (7, "ONE", "c"), (8, "one two", "c"), (9, long, "a"), (10, long + " end", "a"), (11, "To " * 60, "c"),
        (12, "*** $$$ " * 40, "c"), (13, "line a\nline a\nline b\n\n" * 20, "b"), (14, prose, None), (14, prose, None), (15, "é　ü İΣ <|endoftext|> x", None),
        (16, "a b c d e f g h i j", "b"), (17, "a b c d e f g h i j k", "b"), (18, "a b c d e f g h i j k l", "b"),
    ]
    full = [(i, t, "en", s, None, -1, "k", 7, "no", 1) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
