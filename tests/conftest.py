import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA


@pytest.fixture()
def rows():
    """Rows of a frame as a sorted list of dicts."""

    def collect(df):
        out = [r.asDict() for r in df.collect()]
        return sorted(out, key=lambda r: [(str(type(v)), str(v)) for _, v in sorted(r.items())])

    return collect
