import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")
