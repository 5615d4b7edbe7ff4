import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loadcast.session import local_session

    session = local_session("*", 8, app="loadcast-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loadcast-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tmp_root():
    return tempfile.mkdtemp(prefix="loadcast-test-")


@pytest.fixture(scope="session")
def cleaned01(spark):
    """Cleaned sf0.01 meter-day table with STAT_CYCLE carried, cached."""
    from loadcast.plans.pipeline import clean_table
    from loadcast.sources.meter_day import meter_day

    df = clean_table(meter_day(spark, SF01)).cache()
    df.count()
    yield df
    df.unpersist()
