import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import BROADCAST_KEY, build  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build("local[8]", 4, "shelfcast-tests")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every join of group statistics takes the shuffled, salted way."""
    spark.conf.set(BROADCAST_KEY, "-1")
    yield
    spark.conf.unset(BROADCAST_KEY)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture
def rows():
    return rows_of
