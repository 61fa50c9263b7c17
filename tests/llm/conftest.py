import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texts import EDGES, SF  # noqa: E402


@pytest.fixture(scope="session")
def make(spark):
    """Documents with every column of the table, and columns whose names operators use themselves."""

    def build(rows):
        full = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), -1, "x", None) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, node long, value string, kept int"
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def edges(make):
    return make(EDGES)


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
