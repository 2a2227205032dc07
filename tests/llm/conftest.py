import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import LONG  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
            (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "a", 4),
            (5, LONG, "de", "a", len(LONG)), (5, LONG, "de", "a", len(LONG)),
            (6, "don't   stop\n\nnow <|endoftext|> 中文 🎉 émigré's", "en", "b", 40),
            (None, "a row without an id", "en", "b", 19)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
