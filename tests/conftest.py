import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from check import spark_session

    session = spark_session("4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """DataFrame from a schema text and tuples."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make
