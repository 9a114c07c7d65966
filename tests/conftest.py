import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from opsgrain.session import local_session

    session = local_session(8, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
