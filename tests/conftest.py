import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from logstrata.session import get_session

    session = get_session("local[*]", app_name="logstrata-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from logstrata.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)

    return make


def lines_frame(spark, lines):
    from logstrata.schemas import BRONZE_SCHEMA

    return spark.createDataFrame([(line,) for line in lines], BRONZE_SCHEMA)
