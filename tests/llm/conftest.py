import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
TEXTS = [
    (1, f"start one {PASSAGE} tail"), (2, f"other {PASSAGE} end"), (3, f"start one {PASSAGE} tail"),
    (4, None), (5, ""), (6, "  \n\t "), (7, "three words only"), (8, LONG), (9, LONG + " more"),
    (10, "line of text\nline of text\n\nline of text"), (11, "a " * 50), (12, "#*$ || <> é ü 漢字"),
    (13, "start one " + PASSAGE.replace("shared30", "changed") + " tail"),
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


@pytest.fixture(scope="session")
def docs(spark):
    """Texts with nulls, repeats, long ones and columns whose names clash with results."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", len(t or ""), "x", i, "y")
            for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, "
              "n_words long, matches string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
