import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    """The path of the smallest tables."""
    return FOLDER


@pytest.fixture
def table(spark):
    """Make a table of documents with extra columns, one with a name that operators use."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", f"src{n % 3}", None if t is None else len(t), n, "x") for n, (i, t) in enumerate(rows)],
            "doc_id long, text string, lang string, source string, n_chars long, dk long, row string",
        )

    return make
