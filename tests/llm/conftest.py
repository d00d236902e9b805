from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_prose import prose  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n long, id long, component string, gram long, features string, places string"


@pytest.fixture(scope="session")
def data(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns named like the operators' own."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None, True, 1, 2, "x", 3, None, "p") for i, t in rows], DOCS)
    return make


ODD = [(1, None), (2, ""), (3, " \n\t \x0b"), (4, "one"), (5, prose(5, 30_000)), (6, prose(6, 80)), (7, prose(6, 80)), (7, prose(6, 80)),
       (None, "no id here"), (8, "é ß 中文 \U0001f600 <|endoftext|> I'LL 3rd"), (9, "\n\n\n")]


@pytest.fixture(scope="session")
def odd(make_docs):
    """NULLs, empty and very long texts, ties and repeated rows."""
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
