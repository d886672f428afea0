import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tarnlake.session import get_session, ship_package

    session = get_session("tests", cpus="4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    """The driver's smallest tables."""
    return "/root/testdata/sf0.001"
