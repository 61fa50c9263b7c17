import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillcast import session  # noqa: E402
from tillcast.plans.warehouse import build_warehouse  # noqa: E402
from tillcast.sources import sinks  # noqa: E402
from tillcast.sources.literals import example_source  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session.build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def example(spark):
    """The warehouse of the two example sources."""
    return build_warehouse([example_source(spark, 1), example_source(spark, 2)])


@pytest.fixture(scope="session")
def revenue(spark, example):
    return session.stage(example["fact_clients_total_revenue"], "revenue")


@pytest.fixture
def schema(spark):
    """A catalog schema of the test's own, in the shared folder."""
    name = f"t_{uuid.uuid4().hex[:10]}"
    sinks.create_schema(spark, name, session.new_folder(spark, name))
    return name


@pytest.fixture
def day():
    return lambda month, year=2025: dt.date(year, month, 1)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    return lambda df: sorted(map(tuple, df.collect()), key=repr)
